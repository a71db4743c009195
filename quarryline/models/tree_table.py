"""Trees kept as a table: one line per tree, never all of them in one process.

Rows are scored by their cells. Trees cut at known places, so a feature is replaced by the number of the
interval it lies in; rows of one cell have one score. Slices of the cells meet parts of the trees, each
pair in a group of its own, and the parts are added in the order of the trees, so that reruns agree to the
last digit.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml import Model
from pyspark.ml.feature import Bucketizer
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.ml.util import DefaultParamsReader, DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

NODES_PER_TASK = 1 << 20
CELLS_PER_TASK = 1 << 15
TREES_PER_TRIAL = 1 << 20  # places for the trees of a trial in one numbering of all

PACKED = (
    "trial_id int, tree int, n_nodes int, feature binary, threshold binary, below binary, says binary, "
    "w binary, v binary, gain binary, value binary"
)
SCORING = ("trial_id", "tree", "n_nodes", "feature", "threshold", "below", "says")
_BINARY = {"feature": np.int32, "below": np.int32}  # the others hold doubles
_SCHEMA = pa.schema(
    [(c, pa.int32()) for c in ("trial_id", "tree", "n_nodes")]
    + [(c, pa.binary()) for c in ("feature", "threshold", "below", "says", "w", "v", "gain", "value")]
)


def packed(columns: dict[str, np.ndarray], classify: bool, trial_id: int = 0) -> Iterator[pa.RecordBatch]:
    """The nodes of some trees as one line per tree, its nodes in the order of their ids."""
    order = np.lexsort((columns["id"], columns["tree"]))
    c = {k: v[order] for k, v in columns.items()}
    share = np.where(c["w"] > 0, c["v"] / np.where(c["w"] > 0, c["w"], 1), 0)
    c |= {"below": c["left"], "says": share if classify else c["value"]}
    starts = np.flatnonzero(c["id"] == 0)
    for first, end in zip(starts, np.append(starts[1:], len(order))):
        line = [trial_id, int(c["tree"][first]), int(end - first)]
        line += [c[n][first:end].astype(_BINARY.get(n, np.float64)).tobytes() for n in _SCHEMA.names[3:]]
        yield pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(line, _SCHEMA)], schema=_SCHEMA)


def unpacked(line: dict, name: str) -> np.ndarray:
    return np.frombuffer(line[name], _BINARY.get(name, np.float64))


# --- cells ---------------------------------------------------------------------------------------


def with_cells(df: DataFrame, x, ends: dict[int, np.ndarray], width: int, name: str) -> DataFrame:
    """With the cell of each row as ``name``: for the features of ``ends`` the interval, else the value.

    Intervals are closed above, as trees cut them, so the numbers are those of the negated value.
    """
    df = df.withColumn(f"{name}_x", x)
    cut = [i for i in ends if len(ends[i])]
    df = df.withColumns({f"{name}_n{i}": F.lit(0.0) - F.get(f"{name}_x", i) for i in cut})
    if cut:
        places = Bucketizer(
            splitsArray=[[-np.inf, *(0.0 - ends[i][::-1]).tolist(), np.inf] for i in cut], handleInvalid="keep",
            inputCols=[f"{name}_n{i}" for i in cut], outputCols=[f"{name}_b{i}" for i in cut],
        )
        df = places.transform(df)
    parts = [
        F.col(f"{name}_b{i}") if i in cut else F.lit(0.0) if i in ends else F.get(f"{name}_x", i) for i in range(width)
    ]
    used = [f"{name}_x", *[f"{name}_{kind}{i}" for i in cut for kind in "nb"]]
    return df.withColumn(name, F.array(*parts)).drop(*used)


def _values(cells: np.ndarray, ends: dict[int, np.ndarray]) -> np.ndarray:
    """For each feature and cell a value that lies in it, one line per feature."""
    out = np.ascontiguousarray(cells.T)
    for i, cuts in ends.items():
        if len(cuts):
            within = np.concatenate([[np.inf], cuts[::-1], [np.inf]])  # the last one is not a number: right of all
            out[i] = within[out[i].astype(np.int64)]
    return out


def leaf_values(x: np.ndarray, feature, threshold, below, says) -> np.ndarray:
    """What a tree says of each column of ``x`` (features by cells); only cells not at a leaf yet go on."""
    n = x.shape[1]
    flat, out = x.ravel(), np.empty(n)
    below, feature = below.astype(np.int64), feature.astype(np.int64) * n
    here, rows = np.zeros(n, np.int64), np.arange(n)
    while len(rows):
        child = below.take(here)
        inner = child >= 0
        if not inner.all():
            ended = ~inner
            out[rows[ended]] = says.take(here[ended])
            rows, here, child = rows[inner], here[inner], child[inner]
        # not at or below the threshold is to the right, also what is not a number
        here = child + ~(flat.take(feature.take(here) + rows) <= threshold.take(here))
    return out


# --- cells meet trees ----------------------------------------------------------------------------


def part_starts(trees: DataFrame) -> list[int]:
    """Where parts of about ``NODES_PER_TASK`` nodes begin, in the numbering of all trees of all trials."""
    lines = trees.select("trial_id", "tree", "n_nodes").collect()  # one per tree, without its nodes
    starts, size = [], 0
    for trial_id, tree, n in sorted(map(tuple, lines)):
        if not starts or size + n > NODES_PER_TASK:
            starts.append(trial_id * TREES_PER_TRIAL + tree)
            size = 0
        size += n
    return starts


def sums_of_cells(
    trees: DataFrame, starts: list[int], cells: DataFrame, cell: str, ends: dict[int, np.ndarray]
) -> DataFrame:
    """(trial_id, cell, said): what the trees of each trial say of each of the different cells, added up."""
    slices = cells.agg(F.greatest(F.lit(1), F.ceil(F.count(F.lit(1)) / CELLS_PER_TASK)).cast("int")).scalar()
    number = F.col("trial_id").cast("long") * TREES_PER_TRIAL + F.col("tree")
    began = F.filter(F.array(*[F.lit(s).cast("long") for s in starts]), lambda start: start <= number)
    grown = trees.select(*SCORING, F.size(began).alias("part"), slices.alias("slices"))
    grown = grown.withColumn("slice", F.explode(F.sequence(F.lit(0), F.col("slices") - 1))).drop("slices", "n_nodes")
    dealt = cells.select(cell, slices.alias("slices"))
    dealt = dealt.select(
        cell,
        F.pmod(F.xxhash64(cell), "slices").cast("int").alias("slice"),
        F.explode(F.sequence(F.lit(1), F.lit(len(starts)))).alias("part"),
    )
    schema = pa.schema([("trial_id", pa.int32()), ("part", pa.int32()), (cell, pa.list_(pa.float64())), ("said", pa.float64())])

    def score(key: tuple, lines: pa.Table, places: pa.Table) -> pa.Table:
        told, n = places.column(cell).combine_chunks(), places.num_rows
        if not n or not lines.num_rows:
            return schema.empty_table()
        x = _values(told.flatten().to_numpy(zero_copy_only=False).reshape(n, -1), ends)
        sums: dict[int, np.ndarray] = {}
        kept = {c: lines.column(c) for c in ("trial_id", "tree", "feature", "threshold", "below", "says")}
        order = sorted(range(lines.num_rows), key=lambda i: (kept["trial_id"][i].as_py(), kept["tree"][i].as_py()))
        for i in order:
            line = {c: kept[c][i].as_py() for c in kept}
            arrays = [unpacked(line, c) for c in ("feature", "threshold", "below", "says")]
            trial = line["trial_id"]
            sums[trial] = sums.get(trial, 0.0) + leaf_values(x, *arrays)
        tables = []
        for trial, said in sums.items():
            columns = [np.full(n, trial), np.full(n, key[0].as_py()), told, said]
            tables.append(pa.Table.from_arrays([pa.array(a).cast(f.type) for a, f in zip(columns, schema)], schema=schema))
        return pa.concat_tables(tables)

    parts = (
        grown.groupBy("part", "slice")
        .cogroup(dealt.groupBy("part", "slice"))
        .applyInArrow(score, f"trial_id int, part int, {cell} array<double>, said double")
    )
    in_order = F.aggregate(
        F.sort_array(F.collect_list(F.struct("part", "said"))), F.lit(0.0), lambda a, p: a + p["said"]
    )
    return parts.groupBy("trial_id", cell).agg(in_order.alias("said"))


# --- the model -----------------------------------------------------------------------------------


class TreeTable(Model, MLReadable, MLWritable):
    """A fitted ensemble whose trees lie in a folder. It adds the columns that MLlib's models add.

    ``about`` describes it: ``width``, ``trees``, ``nodes``, ``starts`` of the parts, ``ends`` of the cells,
    ``forest`` or not, ``classify``.
    """

    def __init__(self, path: str, about: dict):
        super().__init__()
        self.path, self.about = path, about

    @property
    def getNumTrees(self) -> int:
        return self.about["trees"]

    @property
    def totalNumNodes(self) -> int:
        return self.about["nodes"]

    @property
    def numFeatures(self) -> int:
        return self.about["width"]

    def _table(self, spark: SparkSession) -> DataFrame:
        return spark.read.schema(PACKED).parquet(f"{self.path}/trees")

    def _transform(self, dataset: DataFrame) -> DataFrame:
        about, cell = self.about, "cell"
        while any(c.startswith(cell) for c in dataset.columns):
            cell = f"_{cell}"
        ends = {int(i): np.array(cuts) for i, cuts in about["ends"].items()}
        keyed = with_cells(dataset, vector_to_array("features"), ends, about["width"], cell)
        trees = self._table(dataset.sparkSession)
        sums = sums_of_cells(trees, about["starts"], keyed.select(cell).distinct(), cell, ends)
        joined = keyed.join(sums.select(cell, F.col("said").alias(f"{cell}_said")), cell)
        said = F.col(f"{cell}_said")
        if not about["classify"]:
            score = said / about["trees"] if about["forest"] else said
            return joined.select(*dataset.columns, score.alias("prediction"))
        if about["forest"]:
            one = said / about["trees"]
            raw = [F.lit(float(about["trees"])) - said, said]
        else:
            one = 1 / (1 + F.exp(-2 * said))
            raw = [-said, said]
        return joined.select(
            *dataset.columns,
            array_to_vector(F.array(*raw)).alias("rawPrediction"),
            array_to_vector(F.array(1 - one, one)).alias("probability"),
            (one > 0.5).cast("double").alias("prediction"),
        )

    @property
    def featureImportances(self):
        """Gains by feature, as MLlib adds them: of each tree as shares in a forest."""
        width, forest = self.about["width"], self.about["forest"]

        def gains(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for line in batch.to_pylist():
                    inner = unpacked(line, "below") >= 0
                    gained = np.bincount(unpacked(line, "feature")[inner], unpacked(line, "gain")[inner], width)
                    whole = gained.sum() if forest else 1.0
                    gained = gained / whole if whole else np.zeros(width)
                    columns = [pa.array([line["tree"]], pa.int32()), pa.array([gained.tolist()], pa.list_(pa.float64()))]
                    yield pa.RecordBatch.from_arrays(columns, names=["tree", "gained"])

        read = self._table(SparkSession.active()).select("tree", "feature", "below", "gain")
        lines = read.mapInArrow(gains, "tree int, gained array<double>").orderBy("tree").collect()  # one per tree
        total = np.sum([line["gained"] for line in lines], axis=0)
        return Vectors.dense(total / total.sum() if total.sum() else total)

    def write(self) -> MLWriter:
        return _Writer(self)

    @classmethod
    def read(cls) -> MLReader:
        return _Reader()


class _Writer(MLWriter):
    def __init__(self, model: TreeTable):
        super().__init__()
        self.model = model

    def saveImpl(self, path: str) -> None:
        spark = self.sparkSession
        DefaultParamsWriter.saveMetadata(self.model, path, spark, {"about": self.model.about})
        self.model._table(spark).write.parquet(f"{path}/trees")


class _Reader(MLReader):
    def load(self, path: str) -> TreeTable:
        metadata = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        model = TreeTable(path, metadata["about"])
        model._resetUid(metadata["uid"])
        return model

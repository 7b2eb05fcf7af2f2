"""File sources and sinks."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import groupby
from urllib.parse import quote

import pyarrow as pa
from pyarrow.fs import FileSelector, FileSystem, FileType, LocalFileSystem
from pyspark import TaskContext
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.functions.hashing import xx_u32


def _hidden(path: str) -> bool:
    """Whether Spark's readers pass over a file at this path below the root."""
    return any(p.startswith(".") or p.startswith("_") and "=" not in p for p in path.split("/")) or path.endswith("._COPYING_")


def _listed(spark: SparkSession, root: str) -> DataFrame | None:
    """(path, length) of the files below ``root``, listed by tasks, a folder of the
    first level at a time, so that the driver holds no row per file; None where
    pyarrow cannot open the store."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    path = jvm.org.apache.hadoop.fs.Path(root)
    where = path.getFileSystem(conf).makeQualified(path)
    uri, local = where.toString().rstrip("/"), where.toUri().getScheme() == "file"
    opened = lambda: (LocalFileSystem(), where_) if local else FileSystem.from_uri(uri)
    where_ = where.toUri().getPath()
    del jvm, conf, path, where
    try:
        fs, top = opened()
        entries = fs.get_file_info(FileSelector(top))
    except (OSError, ValueError, NotImplementedError):
        return None
    folders = [(top, False), *((f.path, True) for f in entries if f.type == FileType.Directory and not _hidden(f.base_name))]

    def files(frames):
        fs, top = opened()
        for part in frames:
            for folder, deep in zip(part.column("folder").to_pylist(), part.column("deep").to_pylist()):
                found = [f for f in fs.get_file_info(FileSelector(folder, recursive=deep)) if f.type == FileType.File]
                for at in range(0, len(found), 10_000):
                    rows = [(below, f.size) for f in found[at:at + 10_000] if not _hidden(below := f.path[len(top):].strip("/"))]
                    yield pa.RecordBatch.from_pydict({"path": [f"{uri}/{p}" for p, _ in rows], "length": [n for _, n in rows]},
                                                     pa.schema([("path", pa.string()), ("length", pa.int64())]))

    tasks = min(len(folders), 8 * spark.sparkContext.defaultParallelism)
    return spark.createDataFrame(folders, "folder string, deep boolean").repartition(tasks) \
        .mapInArrow(files, "path string, length long").withColumn("content", _content(opened, uri)("path"))


def _content(opened, uri: str):
    """Reads the file at a path; where the column is not used, no file is opened."""
    def content(path):
        fs, top = opened()
        with fs.open_input_stream(f"{top.rstrip('/')}{path[len(uri):]}") as f:
            return f.read()
    return F.udf(content, "binary", useArrow=False)


def read_documents(spark: SparkSession, root: str, min_name_len: int = 20,
                   label_from_dir: bool = True) -> DataFrame:
    """One file per row (path, name, label from the parent folder,
    content bytes); names of ``min_name_len`` chars or fewer are skipped
    (index / command files).  The tasks list the folders; a store that only
    Spark opens is listed by the driver."""
    df = None if set(root) & set("*?[{") else _listed(spark, root)
    if df is None:
        df = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
    df = df.select("path", "content", "length")
    name = F.element_at(F.split("path", "/"), -1)
    df = df.withColumn("name", name).filter(F.length("name") > min_name_len)
    if label_from_dir:
        df = df.withColumn("label", F.element_at(F.split("path", "/"), -2))
    return df


def write_documents(df: DataFrame, root: str, folder: str, name: str, text: str) -> int:
    """One text file per document, ``<root>/<k>/<folder>=<value>/<name>=<value>.<number>``,
    written by the tasks; k spreads the files over folders that Spark lists in
    parallel.  A row is one line, a null text an empty one; rows of one task with
    the same folder and name are lines of one file.  ``root`` is in a store that
    pyarrow opens; returns the number of files."""
    base = root if "://" in root else "file://" + root.removeprefix("file:")
    none = "__HIVE_DEFAULT_PARTITION__"
    fs, top = FileSystem.from_uri(base)
    fs.create_dir(top, recursive=True)

    def write(frames):
        fs, top = FileSystem.from_uri(base)
        task, files, made = TaskContext.get().partitionId(), 0, set()
        safe = lambda v: quote(str(v), safe=" ") if v not in (None, "") else none
        rows = (r for part in frames for r in zip(*(part.column(c).to_pylist() for c in (folder, name, text))))
        for (f, n), same in groupby(rows, lambda r: (safe(r[0]), safe(r[1]))):
            where = f"{top}/{task}-{files // 1000}/{folder}={f}"
            if where not in made:
                fs.create_dir(where, recursive=True)
                made.add(where)
            with fs.open_output_stream(f"{where}/{name}={n}.{task}-{files}") as out:
                for *_, t in same:
                    out.write((t or "").encode() + b"\n")
            files += 1
        yield pa.RecordBatch.from_pydict({"n": [files]}, pa.schema([("n", pa.int64())]))

    return df.select(folder, name, text).sortWithinPartitions(folder, name) \
        .mapInArrow(write, "n long").agg(F.sum("n")).first()[0] or 0


def with_batches(df: DataFrame, n: int, ids: Sequence[str], seed: int = 42,
                 out: str = "batch") -> DataFrame:
    """S3: a hash batch id in [0, n) (partition-independent)."""
    return df.withColumn(out, F.pmod(xx_u32(*ids, seed=seed), F.lit(n)).cast("int"))


def write_batches(df: DataFrame, path: str, n: int, ids: Sequence[str], seed: int = 42) -> str:
    """S3: write the batches as folders batch=k.  Every task writes its own
    files of each batch, so no batch passes through one task; a stream over the
    folders takes as many files per trigger as it likes."""
    d = with_batches(df, n, ids, seed)
    d.write.mode("overwrite").partitionBy("batch").parquet(path)
    return path


def save_matrix(df: DataFrame, path: str, id_col: str, vec: str) -> None:
    """Out-of-core copy of a matrix as Parquet (id, vector)."""
    df.select(id_col, vec).write.mode("overwrite").parquet(path)


def load_matrix(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def save_model(model, path: str) -> None:
    """S5."""
    model.write().overwrite().save(path)


def load_model(path: str, cls=PipelineModel):
    return cls.load(path)


def write_predictions(df: DataFrame, path: str) -> None:
    """Scored rows as CSV with a header (arrays flattened to text)."""
    from pyspark.sql.types import ArrayType
    out = df
    for f in df.schema.fields:
        if isinstance(f.dataType, ArrayType):
            out = out.withColumn(f.name, F.concat_ws(";", F.col(f.name).cast("array<string>")))
    out.write.mode("overwrite").option("header", True).csv(path)


def model_nodes(spark: SparkSession, tree_model, path: str) -> DataFrame:
    """A fitted decision tree's nodes as rows, read from the model's own
    saved Parquet data (id, prediction, impurity, gain, children, split)."""
    tree_model.write().overwrite().save(path)
    nodes = spark.read.parquet(f"{path}/data")
    cols = nodes.columns
    if "nodeData" in cols:
        nodes = nodes.select("nodeData.*")
    return nodes.select("id", "prediction", "impurity", "gain", "leftChild", "rightChild",
                        F.col("split.featureIndex").alias("feature"),
                        F.try_element_at("split.leftCategoriesOrThreshold", F.lit(1)).alias("threshold"),
                        F.col("impurityStats").alias("counts"))

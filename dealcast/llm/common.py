"""Shared helpers: tables written to the cluster's shared folder, labelled samples."""

from __future__ import annotations

import io
import os
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dealcast.session import ensure_checkpoint_dir

#: Rows per Arrow batch sent to a Python worker; documents can be long, so batches stay small.
ARROW_ROWS = 256

#: Bytes of text that a labelled sample holds, at most.
SAMPLE_BYTES = 64 << 20

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path in the folder that the cluster names in ``spark.checkpoint.dir``."""
    return f"{ensure_checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it again.

    Cuts the lineage like ``checkpoint()``; unlike it, the table read back has a known
    size and no partitioning, so that adaptive execution sees both sides of a later join
    as plain shuffles, whose hot partitions it can split.
    """
    path = shared_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def dropped(df: DataFrame) -> None:
    """Delete a table made by ``written`` that no later step reads."""
    sc = df.sparkSession.sparkContext
    base = ensure_checkpoint_dir(df.sparkSession)
    for path in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        if path.split("://")[-1].lstrip("/").startswith(base.split("://")[-1].replace("file:", "").lstrip("/")):
            target = sc._jvm.org.apache.hadoop.fs.Path(path)
            target.getFileSystem(sc._jsc.hadoopConfiguration()).delete(target, True)


def workers_ready(spark: SparkSession, rows: int = ARROW_ROWS) -> None:
    """Bound the rows of an Arrow batch (a session setting that Spark reads at run time), and
    send this package, by way of the shared folder, to the Python workers if they'd not find it
    by themselves."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    sc = spark.sparkContext
    found = [os.path.abspath(p) for p in [os.getcwd(), *os.environ.get("PYTHONPATH", "").split(os.pathsep)]]
    if root not in found and os.path.isdir(root) and "dealcast.zip" not in sc._python_includes:
        packed = io.BytesIO()
        with zipfile.ZipFile(packed, "w") as z:
            for folder, _, files in os.walk(f"{root}/dealcast"):
                for f in files:
                    if f.endswith(".py"):
                        z.write(f"{folder}/{f}", os.path.relpath(f"{folder}/{f}", root))
        path = sc._jvm.org.apache.hadoop.fs.Path(f"{shared_path(spark, 'package')}/dealcast.zip")
        out = path.getFileSystem(sc._jsc.hadoopConfiguration()).create(path)
        out.write(bytearray(packed.getvalue()))
        out.close()
        sc.addPyFile(path.toString())
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


def ascii_lower(text):
    """Lower-case A-Z only; null becomes the empty text."""
    return F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER)


def row_id(name: str = "doc_id"):
    """``crc32`` of an id as text, the fold rule of the labelled rows; a null id is the empty text."""
    return F.crc32(F.coalesce(F.col(name).cast("string"), F.lit("")).cast("binary"))


def labelled_sample(documents: DataFrame, labels: DataFrame, label: str, learn, bound: int, bound_bytes: int = SAMPLE_BYTES) -> list[tuple[str, int]]:
    """Different texts and labels of at most ``bound`` labelled rows, chosen by a hash of doc_id.

    ``learn`` is the predicate (on doc_id) of the rows that may be learned from. Repeated label
    rows and repeated texts of a doc_id count once; a doc_id with several labels or texts gives
    a row for each. Of these the first ``bound`` by a hash of id and text are taken, and of those
    as many as ``bound_bytes`` hold. Only ids, hashes and lengths pass the two top-k; whole
    texts are read for the rows taken alone.
    """
    spark = documents.sparkSession
    ids = labels.where(F.col(label).isin(0, 1) & F.col("doc_id").isNotNull()).where(learn) \
        .select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("y")).distinct()
    chosen = ids.orderBy(F.xxhash64("doc_id"), "doc_id", "y").limit(bound).collect()
    if not chosen:
        return []
    picked = F.broadcast(spark.createDataFrame(chosen, "doc_id long, y int"))
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    hashed = docs.join(picked, "doc_id").select("doc_id", "y", F.md5(F.col("text").cast("binary")).alias("th"), F.octet_length("text").alias("size"))
    rows = hashed.distinct().orderBy(F.xxhash64("doc_id", "th"), "doc_id", "th", "y").limit(bound).collect()
    taken, used = [], 0
    for r in rows:
        if used + r["size"] <= bound_bytes:
            taken.append((r["doc_id"], r["y"], r["th"]))
            used += r["size"]
    if not taken:
        return []
    wanted = F.broadcast(spark.createDataFrame(taken, "doc_id long, y int, th string"))
    texts = docs.join(wanted.select("doc_id").distinct(), "doc_id", "left_semi").withColumn("th", F.md5(F.col("text").cast("binary"))) \
        .join(wanted, ["doc_id", "th"]).dropDuplicates(["doc_id", "th", "y"]).collect()
    return [(r["text"], r["y"]) for r in sorted(texts, key=lambda r: (r["doc_id"], r["text"], r["y"]))]

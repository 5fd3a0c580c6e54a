"""Sources and sinks: archive records, blobs, zip members, content-addressed tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

LINK = "struct<url:string,text:string,kind:string>"
BLOCK = f"struct<`order`:int,id:string,classes:array<string>,is_content:boolean,text:string,html:string,links:array<{LINK}>>"
#: Schema of an archive's document record; ids are signed and stay text.
RECORD = f"url string, document_id string, title string, representation string, blocks array<{BLOCK}>, content_block_count int, links array<{LINK}>, assets array<string>, retrieved_at double, source_sha256 string, text_sha256 string, source_blob string"


def records(spark: SparkSession, path: str, only_ids: DataFrame | None = None) -> DataFrame:
    """Document records below path; unreadable files are marked in _corrupt_record, not fatal."""
    found = spark.read.schema(RECORD + ", _corrupt_record string").json(path, multiLine=True, recursiveFileLookup=True, pathGlobFilter="document.json", mode="PERMISSIVE")
    return found if only_ids is None else found.join(only_ids.select("document_id"), "document_id", "left_semi")


def blocks(found: DataFrame) -> DataFrame:
    return found.select("document_id", F.explode("blocks").alias("b")).select("document_id", "b.*")


def blobs(spark: SparkSession, path: str) -> DataFrame:
    """path, sha256 and length of gzip or plain blobs, with whether the name is the digest."""

    @F.pandas_udf("binary")
    def plain(content):
        import gzip

        return content.map(lambda x: gzip.decompress(x) if x[:2] == b"\x1f\x8b" else x)

    found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    found = found.withColumn("data", plain("content"))
    digest = F.sha2("data", 256)
    return found.select("path", digest.alias("sha256"), F.octet_length("data").alias("bytes"), F.col("path").contains(digest).alias("verified"))


# Bounds of an archive.
def zip_members(spark: SparkSession, path: str, members: int = 200, one: int = 128 << 20, total: int = 256 << 20) -> DataFrame:
    """PDF members of zip files within bounds, by base name; a member beyond them is left out, a bad archive gives one row with an error."""

    def run(batches):
        import io
        import zipfile

        import pandas as pd

        for batch in batches:
            out = []
            for where, content in zip(batch["path"], batch["content"], strict=True):
                try:
                    with zipfile.ZipFile(io.BytesIO(content)) as z:
                        inside, room = [i for i in z.infolist() if not i.is_dir()], total
                        if len(inside) > members:
                            raise ValueError("archive beyond its bounds")
                        for i in inside:
                            name = i.filename.replace("\\", "/").rsplit("/", 1)[-1]
                            # What a member declares is not believed: at most its bound and one byte are read.
                            with z.open(i) as f:
                                data = f.read(min(one, room) + 1) if name.lower().endswith(".pdf") else b""
                            if data[:5] == b"%PDF-" and len(data) <= min(one, room):
                                room -= len(data)
                                out.append((where, name, data, None))
                except Exception as e:
                    out.append((where, None, None, f"{type(e).__name__}: {e}"[:1000]))
            yield pd.DataFrame(out, columns=["path", "name", "data", "error"])

    found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path", "content")
    return found.mapInPandas(run, "path string, name string, data binary, error string")


def put_new(rows: DataFrame, path: str, content: str = "content") -> DataFrame:
    """Append contents that the table at path does not hold, keyed by digest; returns the rows added."""
    spark = rows.sparkSession
    keyed = rows.withColumn("sha256", F.sha2(F.col(content).cast("binary"), 256)).dropDuplicates(["sha256"])
    try:
        keyed = keyed.join(spark.read.parquet(path).select("sha256"), "sha256", "left_anti")
    except Exception as e:
        if "PATH_NOT_FOUND" not in str(e) and "UNABLE_TO_INFER_SCHEMA" not in str(e):
            raise
    keyed.write.mode("append").parquet(path)
    return keyed

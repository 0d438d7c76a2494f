"""The scan as a stream, run to the end of the files that Spark wrote from the documents."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from checks import views as v
from checks.normalise import FINDING_SQL, LEVEL
from checks.rules import CWE_SQL
from riskloom import schemas
from riskloom.session import shared_dir
from riskloom.streaming import scan as stream

CASES = {}
REASON = "Model score driven by: no explanation available"


def case(name, sql=None):
    def register(build):
        CASES[name] = (build, sql)
        return build
    return register


def _arriving(spark, sf):
    """All corpus files as JSON files of a folder, read as a stream of three micro-batches."""
    path = shared_dir(spark, "arriving")
    rows = v.scored(spark, sf).select(F.concat(F.lit("f"), "doc_id").alias("filename"), F.col("raw_code").alias("code"), "probability")
    rows.repartition(6, "filename").write.json(path)
    schema = T.StructType([*schemas.ARRIVING_FILE.fields, T.StructField("probability", T.DoubleType())])
    return stream.arriving(spark, path, schema, files_per_trigger=2)


@case("str_01_scan_stream", f"""WITH {v.CORPUS} SELECT 'f' || doc_id AS filename, probability >= 0.5 AS is_vulnerable, {LEVEL.format(p='probability')} AS risk_level,
  array_to_string(CASE WHEN probability >= 0.5 THEN list_concat(['{REASON}'], {FINDING_SQL}) ELSE {FINDING_SQL} END, '; ') AS vulnerability_types,
  array_to_string(CASE WHEN probability >= 0.5 AND len({CWE_SQL}) = 0 THEN ['CWE-Unknown'] ELSE {CWE_SQL} END, '; ') AS cwe_ids FROM corpus""")
def str_01(spark, sf):
    details = stream.scan_stream(_arriving(spark, sf)).drop("raw_code")
    out, state = shared_dir(spark, "details"), shared_dir(spark, "offsets")
    stream.write_details(details, out, state, available_now=True).awaitTermination()
    rows = spark.read.schema(details.schema).parquet(out)
    return rows.select(
        "filename", "is_vulnerable", "risk_level", F.array_join("vulnerability_types", "; ").alias("vulnerability_types"), F.array_join("cwe_ids", "; ").alias("cwe_ids"))


@case("str_02_running_summary", f"""WITH {v.CORPUS} SELECT {LEVEL.format(p='probability')} AS risk_level, CAST(count(*) AS BIGINT) AS files,
  CAST(count_if(probability >= 0.5) AS BIGINT) AS vulnerable_files FROM corpus GROUP BY 1""")
def str_02(spark, sf):
    summary = stream.running_summary(stream.scan_stream(_arriving(spark, sf)))
    out, state = shared_dir(spark, "summary"), shared_dir(spark, "offsets")
    stream.write_summary(summary, out, state, available_now=True).awaitTermination()
    return stream.read_summary(spark, out, summary.schema)


@case("str_03_drop_seen", """SELECT DISTINCT sha256(text) AS code_hash FROM documents""")
def str_03(spark, sf):
    path = shared_dir(spark, "arriving")
    rows = v.documents(spark, sf).select(F.concat(F.lit("f"), "doc_id").alias("filename"), F.col("raw_code").alias("code"))
    rows.repartition(6, "filename").write.json(path)
    fresh = stream.drop_seen(stream.arriving(spark, path, files_per_trigger=2)).select("code_hash")
    out, state = shared_dir(spark, "fresh"), shared_dir(spark, "offsets")
    stream.write_details(fresh, out, state, available_now=True).awaitTermination()
    return spark.read.schema("code_hash string").parquet(out)

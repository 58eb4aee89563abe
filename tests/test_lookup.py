"""Look-ups by a column that does not order the table read the row groups that may hold the value."""

from fundlake.session import fresh_dir
from fundlake.sources import write_table


def _rows_read(df):
    found = df.collect()
    return found, df._jdf.queryExecution().executedPlan().collectLeaves().apply(0).metrics().apply("numOutputRows").value()


def test_bloom_filters_skip_row_groups(spark):
    root = fresh_dir(spark, "t-bloom")
    # every file spans all names, so that least and greatest values skip nothing
    df = spark.range(8000).selectExpr("id", "sha2(CAST(id AS STRING), 256) AS name").repartition(4, "id")
    for table, bloom in (("plain", ()), ("bloom", ("name",))):
        assert write_table(df, root, table, bloom_by=bloom) == 8000
    known = df.where("id = 4321").first()["name"]
    for name, rows in ((known, 1), ("8" * 64, 0)):
        plain, read_plain = _rows_read(spark.read.parquet(f"{root}/plain").where(f"name = '{name}'"))
        found, read = _rows_read(spark.read.parquet(f"{root}/bloom").where(f"name = '{name}'"))
        assert found == plain and len(found) == rows and read_plain == 8000
        assert read < 3000 if rows else read == 0

import contextlib
import io

from pyspark.sql import functions as F

from conftest import SF_SMALL
from rateprofile.session import checkpoint_dir, cut_lineage


def _plan(df):
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    return buf.getvalue()


def test_cut_lineage_reads_the_checkpoint_not_the_source(spark):
    assert checkpoint_dir(spark)  # the test session always has a reliable folder
    src = spark.read.parquet(f"{SF_SMALL}/events.parquet").groupBy("user_id").agg(F.count(F.lit(1)).alias("n"))
    assert "FileScan parquet" in _plan(src)
    cut = cut_lineage(src)
    plan = _plan(cut)
    assert "FileScan parquet" not in plan and "HashAggregate" not in plan
    assert sorted(cut.collect()) == sorted(src.collect())

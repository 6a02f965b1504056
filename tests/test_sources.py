"""CSV scan with malformed rows; stream runs with more than one batch."""

from pyspark.sql import functions as F

from shelfwise.schemas import SUPPLIER_CSV
from shelfwise.session import local_path
from shelfwise.sources.csv import bad_rows, good_rows, read_csv, write_csv


def test_csv_quotes_and_corrupt_rows(spark, star, scratch):
    from shelfwise.plans.ingest import csv_suppliers
    path = scratch("csv")
    src = csv_suppliers(star)
    write_csv(src, path)
    # a short and a long row next to the files Spark wrote
    with open(local_path(path) + "/extra.csv", "w") as fh:
        fh.write('supplier_id,supplier_name\n7\n8,"Supplier#8, ""Intl"" Co.",extra\n')
    df = read_csv(spark, path, SUPPLIER_CSV).cache()
    assert good_rows(df).exceptAll(src).count() == 0
    assert good_rows(df).count() == src.count()
    assert bad_rows(df).count() == 2
    assert good_rows(df).where(F.col("supplier_name").contains('"Intl"')).count() == src.count()


def test_stream_batches_and_replay(spark, star, scratch):
    from shelfwise.streaming.jobs import run_enrich
    root = scratch("stream")
    run, fact_path = run_enrich(star, root, n_ranges=3)
    assert run.batches == 3
    stored = spark.read.parquet(fact_path)
    assert stored.select("batch_id").distinct().count() == 3
    from shelfwise.plans.fact import fact_load_line
    batch = fact_load_line(star)
    assert stored.drop("stream", "batch_id").exceptAll(batch).count() == 0
    assert stored.count() == batch.count()

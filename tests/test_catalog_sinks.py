"""Catalog introspection and table write modes."""

from pyspark.sql import functions as F

from parcelspark import schemas
from parcelspark.sinks import tables
from parcelspark.sources import catalog, fixtures
from tests.conftest import SF_SMALL


def test_ensure_table_then_append_by_name(spark, tmpdir_path):
    path = f"{tmpdir_path}/raw/_ingested_files"
    tables.ensure_table(spark, path, schemas.INGESTED_FILES)
    tables.ensure_table(spark, path, schemas.INGESTED_FILES)  # second call is a no-op
    assert tables.read(spark, path).count() == 0
    df = spark.createDataFrame([(3, "events_a.json")], "row_count long, file_name string")
    assert tables.append(df, path, schemas.INGESTED_FILES, {"ingested_at": F.localtimestamp()}) == 1
    row = tables.read(spark, path).collect()[0]
    assert row["file_name"] == "events_a.json" and row["row_count"] == 3
    assert row["ingested_at"] is not None


def test_a_run_that_dies_before_the_commit_leaves_the_old_table(spark, tmpdir_path, monkeypatch):
    path = f"{tmpdir_path}/t"
    assert not tables.exists(spark, path)
    tables.replace(spark.range(3), path)
    old = tables.read(spark, path)

    def die(*_):
        raise KeyboardInterrupt

    with monkeypatch.context() as m:
        m.setattr(tables, "swap_file", die)
        for write in (lambda: tables.replace(spark.range(9), path),
                      lambda: tables.append(spark.range(9), path, old.schema)):
            try:
                write()
            except KeyboardInterrupt:
                pass
            assert tables.read(spark, path).count() == 3
    assert tables.replace(spark.range(5), path) == 5
    assert tables.read(spark, path).count() == 5 and old.count() == 3  # readers of the version before go on
    assert tables.append(spark.range(2), path, old.schema) == 2
    assert tables.read(spark, path).count() == 7


def test_catalog_columns(spark, tmpdir_path):
    p = f"{tmpdir_path}/facilities"
    fixtures.raw_facilities(spark, SF_SMALL).write.parquet(p)
    catalog.register_tables(spark, {"raw_facilities_t": p})
    assert "raw_facilities_t" in catalog.list_tables(spark)
    cols = catalog.catalog_columns(spark, ["raw_facilities_t"]).collect()
    assert [c["column_name"] for c in cols] == [f.name for f in schemas.FACILITIES.fields]
    assert cols[0]["data_type"] == "bigint"


def test_scale_conf_sizes_partitions():
    from parcelspark.session import scale_conf

    conf = scale_conf(6 * 1024**4, executors=1000, cores_per_executor=8)
    assert int(conf["spark.sql.shuffle.partitions"]) == 24576
    small = scale_conf(10 * 1024**2, executors=2, cores_per_executor=4)
    assert int(small["spark.sql.shuffle.partitions"]) == 16  # two waves of cores


def test_scratch_goes_when_the_application_ends(tmpdir_path):
    import os
    import subprocess
    import sys

    code = f"""
from parcelspark.session import build_session, scratch_dir
spark = build_session("local[1]", extra={{"spark.checkpoint.dir": {tmpdir_path!r}}})
path = scratch_dir(spark, "kept")
spark.range(3).write.parquet(path)
assert spark.read.parquet(path).count() == 3
print(path)
"""
    done = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=300,
                          cwd=os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    path = done.stdout.strip().splitlines()[-1]
    assert done.returncode == 0 and path.startswith(tmpdir_path), done.stderr[-2000:]
    assert not os.path.exists(path) and not os.path.exists(os.path.dirname(path))

"""A layer's tables change together: failed, concurrent and repeated runs."""

import pytest

from fundlake.plans import etl, star
from fundlake.session import fresh_dir
from fundlake.sources import LayerRun, create_layers, current, publish, read_table, snapshot, vacuum, versions, write_bronze_all

from conftest import SF001


@pytest.fixture(scope="module")
def lake(spark):
    """Two load dates landed, the first one built and registered."""
    root = fresh_dir(spark, "t-snap")
    entities = star.bronze_entities(spark, SF001)
    write_bronze_all(entities, f"{root}/bronze", "2002-01-01")
    less = {e: df.limit(5) for e, df in entities.items()}
    write_bronze_all(less, f"{root}/bronze", "2002-02-01")
    etl.run_silver(spark, f"{root}/bronze", f"{root}/silver", "2002-01-01", 2002, register=True)
    return root


def _state(spark, lake):
    rows = {t: read_table(spark, f"{lake}/silver", t).count() for t in etl.SILVER_TABLES}
    return rows, {t: spark.table(f"silver.{t}").count() for t in etl.SILVER_TABLES}


def test_failing_sixth_table_leaves_the_old_state_everywhere(spark, lake, monkeypatch):
    before, version = _state(spark, lake), current(spark, f"{lake}/silver").version
    written = []

    def failing(df, root, name, **layout):
        if len(written) == 3:  # two tables in buckets came before
            raise OSError("disk full")
        written.append(name)
        return original(df, root, name, **layout)

    original = snapshot.write_table
    monkeypatch.setattr(snapshot, "write_table", failing)
    with pytest.raises(OSError):
        etl.run_silver(spark, f"{lake}/bronze", f"{lake}/silver", "2002-02-01", 2002, register=True)
    assert len(written) == 3
    assert _state(spark, lake) == before and current(spark, f"{lake}/silver").version == version
    monkeypatch.undo()
    # Gold of the same lake is built from one version, and the next good run replaces all tables
    etl.run_gold(spark, f"{lake}/silver", f"{lake}/gold")
    assert read_table(spark, f"{lake}/gold", "portfolio_table").count() == before[0]["portfolio_companies"]
    counts = etl.run_silver(spark, f"{lake}/bronze", f"{lake}/silver", "2002-02-01", 2002, register=True)
    assert _state(spark, lake) == (counts, counts) and counts["portfolio_companies"] == 5
    # the version before can still be read
    assert versions(spark, f"{lake}/silver")[-2].read(spark, "portfolio_companies").count() == before[0]["portfolio_companies"]


def test_failing_registration_restores_the_catalog(spark, monkeypatch):
    root = fresh_dir(spark, "t-snap-cat")
    create_layers(spark, root, ["snapdb"])
    for n in (3, 7):
        run = LayerRun(spark, f"{root}/layer")
        for name in ("a", "b", "c"):
            run.write(spark.range(n), name)
        snap = run.commit()
        if n == 3:
            publish(spark, "snapdb", snap)
    original = snapshot.register_table

    def failing(spark_, database, name, path, fmt="parquet"):
        if name == "c" and path == snap.path("c"):
            raise RuntimeError("catalog down")
        return original(spark_, database, name, path, fmt)

    monkeypatch.setattr(snapshot, "register_table", failing)
    with pytest.raises(RuntimeError):
        publish(spark, "snapdb", snap)
    assert [spark.table(f"snapdb.{t}").count() for t in "abc"] == [3, 3, 3]
    monkeypatch.undo()
    publish(spark, "snapdb", snap)
    assert [spark.table(f"snapdb.{t}").count() for t in "abc"] == [7, 7, 7]


def test_counts_are_checked_before_publishing(spark):
    root = fresh_dir(spark, "t-snap-count")
    run = LayerRun(spark, root)
    run.write(spark.range(10), "t")
    spark.range(1).write.mode("append").parquet(f"{root}/{run._paths['t']}")
    with pytest.raises(snapshot.CountMismatch):
        run.commit()
    assert current(spark, root) is None


def test_of_two_runs_of_one_version_the_second_fails(spark):
    root = fresh_dir(spark, "t-snap-two")
    first, second = LayerRun(spark, root), LayerRun(spark, root)
    first.run_id, second.run_id = "0" * 32, "f" * 32
    first.write(spark.range(1), "t")
    second.write(spark.range(2), "t")
    first.commit()
    with pytest.raises(snapshot.ConcurrentRun):
        second.commit()
    assert read_table(spark, root, "t").count() == 1


def test_kept_tables_and_vacuum(spark):
    root = fresh_dir(spark, "t-snap-keep")
    run = LayerRun(spark, root)
    run.write(spark.range(4), "a")
    run.write(spark.range(5), "b")
    first = run.commit()
    for n in (6, 7):
        run = LayerRun(spark, root)
        run.keep("a")
        run.write(spark.range(n), "b")
        run.commit()
    LayerRun(spark, root).write(spark.range(1), "a")  # never published
    assert read_table(spark, root, "a").count() == 4 and read_table(spark, root, "b").count() == 7
    assert vacuum(spark, root, keep=2) == []  # too young
    gone = vacuum(spark, root, keep=1, older_than_hours=0)
    assert len(gone) == 2 and first.run_id not in gone
    assert read_table(spark, root, "a").count() == 4 and read_table(spark, root, "b").count() == 7

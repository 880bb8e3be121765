"""Layers whose tables change together."""

import pytest

from cashweave.operators.upserts import MissingMerchantError
from cashweave.plans import monthly
from cashweave.plans.store import Store
from small import local, rows
from test_monthly import FILES, _inputs

TABLES = ("merchant", "sku", "note_sku_va_map", "remarks_category_map")


class Ended(Exception):
    pass


def _state(store, names=TABLES):
    version = store.current("ref")
    return {n: rows(version.read(n)) for n in names}


def _ended_at(monkeypatch, number):
    """Let the n-th write of a published layer end the run, before or in the middle of it."""
    done, write, commit = [], Store.write, Store._commit

    def counted(self, df, layer, name, mode="overwrite", by=None):
        if layer == "ref":
            done.append(name)
            if len(done) == number:
                write(self, df.limit(0), layer, name, mode, by)  # some of its files are there
                raise Ended(name)
        write(self, df, layer, name, mode, by)

    def committed(self, version):
        done.append("commit")
        if len(done) == number:
            raise Ended("commit")
        commit(self, version)

    monkeypatch.setattr(Store, "write", counted)
    monkeypatch.setattr(Store, "_commit", committed)
    return done


def test_a_run_ended_at_any_write_leaves_the_earlier_state(spark, tmp_path):
    in_dir, out = _inputs(tmp_path / "in"), str(tmp_path / "out")
    store = monthly.load_month(spark, in_dir, out)
    before = _state(store)
    other = {n: FILES[n].replace("\nB,", "\nC,").replace("ABC,B", "NEW,C") for n in ("repmt_sku_2025-09.csv", "repmt_sales_2025-09.csv", "level1_reference.csv")}
    following = _inputs(tmp_path / "next", **other)
    monthly.normalise_feeds(store, following)
    monthly.extract_mapping(store, following)
    monthly.load_raw(store)
    for number in range(1, 6):  # four tables and the commit
        with pytest.MonkeyPatch.context() as patch:
            _ended_at(patch, number)
            with pytest.raises(Ended):
                monthly.load_reference(store, store)
        assert _state(store) == before
        assert len(store.versions("ref")) == 1
        assert {n: rows(store.find("ref", n)) for n in TABLES} == before
    monthly.load_reference(store, store)
    after = _state(store)
    assert [r[0] for r in after["sku"]] == ["A", "B", "C"] and after != before
    # What the ended runs left can go; the version before the current one stays.
    assert len(store.drop_old("ref", keep=2)) == 5
    assert {n: rows(store.versions("ref")[0].read(n)) for n in TABLES} == before
    assert len(store.drop_old("ref", keep=1)) == 1
    assert _state(store) == after


def test_a_bad_mapping_leaves_the_earlier_state(spark, tmp_path):
    store = monthly.load_month(spark, _inputs(tmp_path / "in"), str(tmp_path / "out"))
    before = _state(store)
    bad = {"level1_reference.csv": FILES["level1_reference.csv"].replace("\nB,", "\nUNKNOWN,")}
    with pytest.raises(MissingMerchantError):
        monthly.load_month(spark, _inputs(tmp_path / "bad", **bad), str(tmp_path / "out"), previous=str(tmp_path / "out"))
    assert _state(store) == before and len(store.versions("ref")) == 1


def test_versions(spark, tmp_path):
    store = Store(spark, str(tmp_path))
    assert store.current("x") is None and store.versions("x") == [] and store.drop_old("x") == []
    a, b = (local(spark, [(i,)], "n long") for i in (1, 2))
    first = store.publish("x", {"a": a, "b": a})
    second = store.publish("x", {"b": store.read("x", "b").unionByName(b)})  # from the version it follows
    assert [v.sequence for v in store.versions("x")] == [1, 2]
    assert (rows(store.read("x", "a")), rows(store.read("x", "b"))) == ([(1,)], [(1,), (2,)])
    assert (rows(first.read("b")), second.tables) == ([(1,)], ("a", "b"))
    assert store.find("x", "c") is None
    with pytest.raises(ValueError, match="no table 'c'"):
        second.read("c")
    with pytest.raises(ValueError, match="stay"):
        store.drop_old("x", keep=0)
    store.write(a, "plain", "t")
    assert rows(store.read("plain", "t")) == [(1,)] and store.find("plain", "u") is None


def test_sums_are_observed_while_a_table_is_written(spark, tmp_path):
    from pyspark.sql import functions as F

    store = Store(spark, str(tmp_path))
    rows_of = spark.range(0, 1000, 1, 7).selectExpr("id", "if(id % 10 = 0, null, id / 4) AS amount")
    sums = {"rows": F.count(F.lit(1)), "amount": F.sum(F.col("amount").cast("decimal(18,2)")), "large": F.count_if(F.col("id") > 900)}
    assert store.metrics("raw", "t") is None
    store.write_observed(rows_of, "raw", "t", sums)
    amount = sum(i / 4 for i in range(1000) if i % 10)
    assert store.metrics("raw", "t") == {"rows": 1000, "amount": amount, "large": 99}
    store.write_observed(rows_of.limit(10), "raw", "t", sums, mode="append")
    assert store.metrics("raw", "t")["rows"] == 1010 == store.read("raw", "t").count()
    store.write_observed(rows_of.where("id < 0"), "raw", "t", sums)
    assert store.metrics("raw", "t") == {"rows": 0, "amount": 0, "large": 0}
    with pytest.MonkeyPatch.context() as patch:  # a write that fails leaves no sums of the table before

        def fails(self, df, layer, name, mode="overwrite", by=None, write=Store.write):
            if layer == "raw":
                raise Ended(name)
            write(self, df, layer, name, mode, by)

        patch.setattr(Store, "write", fails)
        with pytest.raises(Ended):
            store.write_observed(rows_of, "raw", "t", sums)
    assert store.metrics("raw", "t") is None


def test_the_ledger_is_parsed_once(spark, tmp_path, monkeypatch):
    """Transactions, flows and transfers come from the typed ledger; checks count no raw rows."""
    from cashweave.operators import typed
    from cashweave.plans import quality

    parsed, plain = [], typed.typed_ledger
    monkeypatch.setattr(typed, "typed_ledger", lambda *a, **b: parsed.append(1) or plain(*a, **b))
    store = monthly.load_month(spark, _inputs(tmp_path / "in"), str(tmp_path / "out"))
    assert len(parsed) == 1
    monkeypatch.setattr(quality, "check_raw_data", lambda *a: pytest.fail("raw rows were counted again"))
    monkeypatch.setattr(quality, "check_tolerance", lambda *a, **b: pytest.fail("the band was tested again"))
    results = {r["check"]: r["detail"] for r in monthly.suite(store).collect()}
    assert results["raw_data"] == "9 raw rows"
    monthly.append_demo_outflows(store)
    assert {r["check"]: r["detail"] for r in monthly.suite(store).collect()}["raw_data"] == "12 raw rows"

"""Snapshot tables by their log: whole writes or none, columns without footers, and what is read."""

import datetime
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from creditmart.operators import features
from creditmart.plans import prepare, vocabulary
from creditmart.session import scratch_path
from creditmart.sources import log, tables

MONTHS = [f"2023-{m:02d}-01" for m in range(1, 13)]


def day(text):
    return datetime.date.fromisoformat(text)


def rows_of(spark, rows, schema="k string, snapshot_date date"):
    return spark.createDataFrame([(*r[:-1], day(r[-1])) for r in rows], schema)


def content(frame):
    return sorted(map(tuple, frame.collect()), key=repr)


@pytest.fixture
def table(spark):
    path = scratch_path(spark, "logged")
    tables.write_snapshots(rows_of(spark, [(f"{m}", m) for m in MONTHS]), path)
    return path


def test_a_write_that_fails_halfway_changes_nothing(spark, table):
    before, state = content(tables.read_snapshots(spark, table)), log.latest(spark, table)
    late = F.when(F.col("id") == 999, F.raise_error("broken").cast("string")).otherwise(F.lit("new"))
    month = F.element_at(F.array(*[F.lit(day(m)) for m in MONTHS]), (F.col("id") % 6 + 1).cast("int"))
    broken = spark.range(0, 1000, 1, 8).select(late.alias("k"), month.alias("snapshot_date"))
    with pytest.raises(Exception, match="broken"):
        tables.write_snapshots(broken, table, dates=MONTHS)
    assert log.latest(spark, table) == state
    assert content(tables.read_snapshots(spark, table)) == before


def test_a_run_that_ends_before_its_commit_changes_nothing(spark, table, monkeypatch):
    before = content(tables.read_snapshots(spark, table))

    def killed(*_):
        raise KeyboardInterrupt

    with monkeypatch.context() as patch:
        patch.setattr(log, "commit", killed)
        with pytest.raises(KeyboardInterrupt):
            tables.write_snapshots(rows_of(spark, [("new", m) for m in MONTHS[:6]]), table, dates=MONTHS)
    # All files lie there, and none is read.
    assert len([n for n in log.Folder(spark, table).names() if n.startswith("_run=")]) == 2
    assert content(tables.read_snapshots(spark, table)) == before
    tables.write_snapshots(rows_of(spark, [("new", m) for m in MONTHS[:6]]), table, dates=MONTHS)
    assert content(tables.read_snapshots(spark, table)) == [("new", day(m)) for m in MONTHS[:6]]
    gone = log.remove_replaced(spark, table)
    assert len([name for name in gone if name.startswith("_run=")]) == 2
    assert content(tables.read_snapshots(spark, table)) == [("new", day(m)) for m in MONTHS[:6]]


def test_one_snapshot_opens_its_own_files_only(spark, table):
    tables.write_snapshots(rows_of(spark, [("x", 1, MONTHS[-1])], "k string, young int, snapshot_date date"), table)
    one = tables.read_snapshots(spark, table, [MONTHS[2]])
    assert one.columns == ["k", "young", "snapshot_date"]
    assert len(one.inputFiles()) == 1 and f"snapshot_date={MONTHS[2]}" in one.inputFiles()[0]
    # Files of other snapshots may be anything.
    for file in Path(table).rglob("*.parquet"):
        if MONTHS[2] not in str(file):
            file.write_bytes(b"no parquet")
    assert content(tables.read_snapshots(spark, table, [MONTHS[2]])) == [(MONTHS[2], None, day(MONTHS[2]))]


def test_a_column_of_another_type(spark, table):
    other = rows_of(spark, [(1, m) for m in MONTHS], "k int, snapshot_date date")
    before = log.Folder(spark, table).names()
    with pytest.raises(ValueError, match="column k"):
        tables.write_snapshots(other.limit(3), table)
    with pytest.raises(ValueError, match="column k"):
        tables.write_snapshots(other, table, dates=MONTHS[:5])
    tables.write_snapshots(other, table, dates=MONTHS)
    assert tables.read_snapshots(spark, table).schema["k"].dataType.simpleString() == "int"
    assert len(log.Folder(spark, table).names()) >= len(before)


def test_two_writers_keep_both_changes(spark, table, monkeypatch):
    create, interrupted = log.Folder.create, []

    def slow(folder, name, text):
        if not interrupted:
            interrupted.append(name)
            tables.write_snapshots(rows_of(spark, [("theirs", MONTHS[0])]), table)
        return create(folder, name, text)

    monkeypatch.setattr(log.Folder, "create", slow)
    tables.write_snapshots(rows_of(spark, [("ours", MONTHS[1])]), table)
    found = content(tables.read_snapshots(spark, table, MONTHS[:3]))
    assert [k for k, _ in found] == [MONTHS[2], "ours", "theirs"]
    assert log.latest(spark, table).version == 2


def test_rows_without_a_snapshot_and_odd_names(spark):
    path = scratch_path(spark, "odd")
    rows = spark.createDataFrame([(1, "a b/c=d:%"), (2, None), (3, "")], "`k.1` int, part string")
    tables.write_snapshots(rows, path, by="part")
    assert content(tables.read_snapshots(spark, path, values=["a b/c=d:%"], by="part")) == [(1, "a b/c=d:%")]
    # Spark keeps the empty text as no value.
    assert content(tables.read_snapshots(spark, path, by="part")) == [(1, "a b/c=d:%"), (2, None), (3, None)]


def test_empty_tables(spark):
    path = scratch_path(spark, "empty")
    tables.write_snapshots(rows_of(spark, []), path, dates=MONTHS[:2])
    assert tables.read_snapshots(spark, path).columns == ["k", "snapshot_date"]
    assert tables.read_snapshots(spark, path).count() == 0
    assert tables.read_snapshots(spark, path, [MONTHS[5]]).count() == 0


def test_csv_snapshots_keep_their_columns(spark):
    path = scratch_path(spark, "text")
    schema = "a string, b string, snapshot_date date"
    tables.write_snapshots(rows_of(spark, [("1", " x", MONTHS[0])], schema), path, fmt="csv")
    tables.write_snapshots(rows_of(spark, [("2", "y ", MONTHS[1])], schema).select("snapshot_date", "b", "a"), path, fmt="csv")
    assert content(tables.read_snapshots(spark, path)) == [("1", " x", day(MONTHS[0])), ("2", "y ", day(MONTHS[1]))]
    with pytest.raises(ValueError, match="same columns"):
        tables.write_snapshots(rows_of(spark, [("1", MONTHS[2])], "a string, snapshot_date date"), path, fmt="csv")


def test_a_younger_column_is_what_it_was_declared_to_be(spark):
    path = scratch_path(spark, "grown")
    known = rows_of(spark, [("a", False, MONTHS[0]), ("b", True, MONTHS[0]), ("c", None, MONTHS[0])], "k string, unknown boolean, snapshot_date date")
    tables.write_snapshots(known, path)
    count = tables.absent_as(F.lit(5), "n", 0, unless="unknown")
    tables.write_snapshots(rows_of(spark, [("d", False, MONTHS[1])], known.schema).select("*", count), path)
    found = {r.k: r.n for r in tables.read_snapshots(spark, path).collect()}
    assert found == {"a": 0, "b": None, "c": None, "d": 5}
    # The rule outlives being read and written again.
    again = scratch_path(spark, "again")
    tables.write_snapshots(tables.read_snapshots(spark, path, [MONTHS[1]]), again)
    tables.write_snapshots(known, again)
    assert {r.k: r.n for r in tables.read_snapshots(spark, again).collect()} == found


def test_sets_and_parameters_change_together(spark, monkeypatch):
    path = scratch_path(spark, "model")
    loan = "loan_id string, Customer_ID string, loan_start_date date, label int, label_def string, snapshot_date date"

    def run(shift):
        labels = [(str(i), str(i), day(MONTHS[i % 5]), i // 5 % 2, "x", day(MONTHS[6])) for i in range(60)]
        rows = [(str(i), float(i + shift), "p" if i % 3 else "q", day(MONTHS[i % 5])) for i in range(60)]
        tables.write_table(spark.createDataFrame(labels, loan), f"{path}/labels")
        tables.write_table(spark.createDataFrame(rows, "Customer_ID string, Outstanding_Debt double, Credit_Mix string, snapshot_date date"), f"{path}/features")
        return prepare.prepare_tables(spark, f"{path}/features", f"{path}/labels", path)

    run(0)
    fields, sets = prepare.load_fields(spark, path), content(prepare.load_set(spark, path, "train"))
    write = tables.write_snapshots

    def fails_at_the_sets(df, place, *args, **named):
        if place.endswith("/sets"):
            raise OSError("full")
        write(df, place, *args, **named)

    with monkeypatch.context() as patch:
        patch.setattr(tables, "write_snapshots", fails_at_the_sets)
        with pytest.raises(OSError, match="full"):
            run(1000)
    assert prepare.load_fields(spark, path) == fields
    assert content(prepare.load_set(spark, path, "train")) == sets
    run(1000)
    assert prepare.load_fields(spark, path) != fields


def test_the_vocabulary_only_grows(spark, monkeypatch):
    silver, path = scratch_path(spark, "silver"), scratch_path(spark, "loan-types")

    def deliver(month, *lists):
        tables.write_snapshots(rows_of(spark, [(text, month) for text in lists], "Type_of_Loan string, snapshot_date date"), silver, dates=[month])

    deliver(MONTHS[0], "Student Loan, Auto Loan", None)
    deliver(MONTHS[1], "Student Loan")
    first = vocabulary.learn(spark, silver, path)
    assert first == ["Auto Loan", "Student Loan"]
    version = log.latest(spark, path).version
    read = []
    real = tables.read_snapshots

    def noting(spark_, place, *args, **named):
        if place == silver:
            read.append(sorted(named["values"]))
        return real(spark_, place, *args, **named)

    monkeypatch.setattr(tables, "read_snapshots", noting)
    assert vocabulary.learn(spark, silver, path) == first and not read
    assert log.latest(spark, path).version == version
    deliver(MONTHS[2], "A Loan, Student Loan")
    assert vocabulary.learn(spark, silver, path) == [*first, "A Loan"] and read == [[MONTHS[2]]]
    # A month written anew is read again; nothing is forgotten.
    deliver(MONTHS[0], "Mortgage Loan")
    deliver(MONTHS[3], None)
    assert vocabulary.learn(spark, silver, path) == [*first, "A Loan", "Mortgage Loan"]
    assert read[1] == [MONTHS[0], MONTHS[3]]
    ordinals = [tuple(r) for r in vocabulary.entries(spark, path).orderBy("ordinal").collect()]
    assert [n for n, _ in ordinals] == list(range(1, len(ordinals) + 1))
    monkeypatch.setattr(features.config, "MAX_COLUMNS", 2)
    deliver(MONTHS[4], "E, F, G")
    with pytest.raises(ValueError, match="more than 2"):
        vocabulary.learn(spark, silver, path)
    monkeypatch.setattr(features.config, "MAX_COLUMNS", 100)
    assert vocabulary.learn(spark, silver, path)[-3:] == ["E", "F", "G"]

import os
import time

import pytest
from pyspark.sql import functions as F

from tradelens.operators.load import keep_last, stamp, upsert_keep_last
from tradelens.schema import COTTON_COLUMNS, MONTH, QTY1, TRADE_SCHEMA, YEAR
from tradelens.session import scratch_path
from tradelens.sources import commits, extract, files
from tradelens.sources.table import normalise, read_table, table_freshness, upsert_table, write_table
from tradelens.streaming.upsert_stream import stream_upsert

from conftest import make_trade

COLS = [f.name for f in TRADE_SCHEMA.fields]


def rows_of(df):
    return sorted(tuple(r) for r in df.select(*COLS).collect())


def test_keep_last_within_batch_and_null_keys(spark):
    rows = [("E", "A", "B", "3101", 2020, 1, 1.0, 1.0), ("E", "A", "B", "3101", 2020, 1, 1.0, 2.0),
            ("E", "A", None, "3101", 2020, 1, 1.0, 3.0), ("E", "A", None, "3101", 2020, 1, 1.0, 4.0)]
    out = keep_last(stamp(make_trade(spark, rows).coalesce(1))).collect()
    assert sorted((r.PARTNER or "", r[QTY1]) for r in out) == [("", 4.0), ("B", 2.0)]


def test_upsert_replaces_and_adds(spark):
    old = make_trade(spark, [("E", "A", "B", "3101", 2019, 1, 1.0, 1.0), ("E", "A", "B", "3101", 2020, 1, 1.0, 1.0)])
    new = make_trade(spark, [("E", "A", "B", "3101", 2020, 1, 1.0, 9.0), ("E", "A", "B", "3101", 2020, 2, 1.0, 5.0)])
    out = {(r[YEAR], r[MONTH]): r[QTY1] for r in upsert_keep_last(old, new).collect()}
    assert out == {(2019, 1): 1.0, (2020, 1): 9.0, (2020, 2): 5.0}


def test_table_upsert_idempotent_and_stream_equals_batch(spark):
    old = make_trade(spark, [("E", "A", p, "3101", y, m, 1.0, 1.0) for p in "BC" for y in (2019, 2020)
                             for m in range(1, 13)])
    new = make_trade(spark, [("E", "A", p, "3101", 2020, m, 1.0, 7.0) for p in "BD" for m in range(1, 13)])
    expected = rows_of(upsert_keep_last(old, new))
    path = scratch_path(spark, "t")
    upsert_table(old, path, full=True)
    upsert_table(new, path)
    assert rows_of(read_table(spark, path)) == expected
    upsert_table(new, path)                      # same batch again: no change
    assert rows_of(read_table(spark, path)) == expected

    spath, landing = scratch_path(spark, "t"), scratch_path(spark, "landing")
    upsert_table(old, spath, full=True)
    for lo, hi in ((1, 4), (5, 8), (9, 12)):
        new.where(F.col(MONTH).between(lo, hi)).coalesce(1).write.mode("append").parquet(landing)
    stream_upsert(spark, landing, spath, scratch_path(spark, "ck"), new.schema, max_files_per_trigger=1)
    assert rows_of(read_table(spark, spath)) == expected


def test_extract_encodings_round_trip(spark):
    rows = [("E", "Côte d'Ivoire", 'say "hi"', "3102", 2020, 1, 12.5, 3.0),
            ("E", "Brazil", "", "310520", 2020, 2, 1.25, 4.0),
            ("E", "Brazil", "NA", "3105", 2020, 3, 1.0, 5.0)]
    df = make_trade(spark, rows).coalesce(1)     # one file per encoding
    root = scratch_path(spark, "enc")
    extract.write_extract(df, f"{root}/a", encoding="UTF-16")
    extract.write_extract(df, f"{root}/b", encoding="ISO-8859-1")
    extract.write_extract(df, f"{root}/c", encoding="UTF-8", bom=True)
    extract.write_extract(df, f"{root}/d", encoding="UTF-8")
    encs = {os.path.basename(os.path.dirname(p.replace("file:", ""))): e
            for p, e in extract.inspect_files(spark, f"{root}/*").select("FILE", "ENCODING").collect()}
    assert encs == {"a": "UTF-16BE", "b": "ISO-8859-1", "c": "UTF-8", "d": "UTF-8"}
    want = sorted([("Côte d'Ivoire", 'say "hi"', 3.0), ("Brazil", None, 4.0), ("Brazil", None, 5.0)])
    for sub in "abcd":
        got = extract.read_extracts(spark, f"{root}/{sub}", "E").collect()
        assert sorted((r.REPORTER, r.PARTNER, r.QTY1) for r in got) == want, sub


def test_missing_column_fails_before_read(spark):
    df = make_trade(spark, [("E", "A", "B", "3101", 2020, 1, 1.0, 1.0)]).drop("QTY1")
    root = scratch_path(spark, "bad")
    df.write.option("header", True).option("sep", "\t").csv(root)
    try:
        extract.read_extract(spark, root, "E")
    except ValueError as e:
        assert "QTY1" in str(e)
    else:
        raise AssertionError("missing column not reported")


def test_ingest_full_then_incremental(spark):
    from tradelens.dims import fixture_dims
    from tradelens.sources.ingest import ingest
    from conftest import SF_SMALL

    dims = fixture_dims(spark, SF_SMALL)
    first = make_trade(spark, [("E", "NATION_0", p, "3102", y, m, 1.0, 1.0)
                               for p in ("NATION_1", "NATION_2") for y in (2019, 2020) for m in (1, 2)])
    second = make_trade(spark, [("E", "NATION_0", "NATION_1", "3102", 2020, 2, 1.0, 9.0),
                                ("E", "NATION_0", "NATION_1", "3102", 2020, 3, 1.0, 5.0)])
    root, path = scratch_path(spark, "ingest"), scratch_path(spark, "table")
    extract.write_extract(first.coalesce(1), f"{root}/a", encoding="UTF-16")
    extract.write_extract(second.coalesce(1), f"{root}/b", encoding="ISO-8859-1")
    a1 = ingest(spark, f"{root}/a", path, "E", dims, full=True).first()
    assert (a1.ROWS_BEFORE, a1.ROWS_FETCHED, a1.ROWS_AFTER) == (0, 8, 8)
    a2 = ingest(spark, f"{root}/b", path, "E", dims).first()
    assert (a2.ROWS_BEFORE, a2.ROWS_FETCHED, a2.ROWS_AFTER, a2.ROWS_NEW) == (8, 2, 9, 1)
    t = {(r[YEAR], r[MONTH], r.PARTNER): r[QTY1] for r in read_table(spark, path).collect()}
    assert t[(2020, 2, "NATION_1")] == 9.0 and t[(2020, 3, "NATION_1")] == 5.0 and t[(2019, 1, "NATION_2")] == 1.0
    assert {r.REGION for r in read_table(spark, path).collect()} == {"NAM", "Asia"}


def land(folder, name, text, encoding="utf-8", at=None):
    """One extract file with the given landing time."""
    folder = folder.replace("file:", "")
    os.makedirs(folder, exist_ok=True)
    path = os.path.join(folder, name)
    with open(path, "wb") as f:
        f.write(text.encode(encoding))
    if at is not None:
        os.utime(path, (at, at))


HEAD = "REPORTER\tPARTNER\tCOMMODITY\tYEAR\tMONTH\tVALUE\tQTY1\n"


def test_new_column_keeps_stored_rows(spark):
    path = scratch_path(spark, "t")
    old = make_trade(spark, [("E", "A", "B", "3101", y, 1, 1.0, 1.0) for y in (2018, 2019, 2020)])
    upsert_table(old.drop("VALUE"), path)
    upsert_table(make_trade(spark, [("E", "A", "C", "3101", 2020, 1, 5.0, 2.0)]), path)
    got = sorted((r[YEAR], r.PARTNER, r.VALUE, r[QTY1]) for r in read_table(spark, path).collect())
    assert got == [(2018, "B", None, 1.0), (2019, "B", None, 1.0), (2020, "B", None, 1.0), (2020, "C", 5.0, 2.0)]


def test_batch_without_a_column_keeps_stored_values(spark):
    path = scratch_path(spark, "t")
    upsert_table(make_trade(spark, [("E", "A", "B", "3101", 2020, 1, 11.0, 1.0)]), path)
    upsert_table(make_trade(spark, [("E", "A", "C", "3101", 2020, 1, 0.0, 2.0)]).drop("VALUE"), path)
    got = sorted((r.PARTNER, r.VALUE) for r in read_table(spark, path).collect())
    assert got == [("B", 11.0), ("C", None)]


def test_type_difference_and_bad_month_raise(spark):
    path = scratch_path(spark, "t")
    row = make_trade(spark, [("E", "A", "B", "3101", 2020, 1, 1.0, 1.0)])
    upsert_table(row, path)
    with pytest.raises(ValueError, match="types differ"):
        upsert_table(row.withColumn(QTY1, F.col(QTY1).cast("string")), path)
    with pytest.raises(ValueError, match="1..12"):
        upsert_table(row.withColumn(MONTH, F.lit(13)), path)
    assert read_table(spark, path).count() == 1


def test_full_load_keeps_the_other_flow(spark):
    path = scratch_path(spark, "t")
    upsert_table(make_trade(spark, [("I", "A", "B", "3101", 2019, 1, 1.0, 1.0)]), path, full=True)
    upsert_table(make_trade(spark, [("E", "A", "B", "3101", y, 1, 1.0, 1.0) for y in (2019, 2020)]), path, full=True)
    upsert_table(make_trade(spark, [("E", "A", "B", "3101", 2020, 2, 1.0, 3.0)]), path, full=True)
    got = sorted((r.FLOW, r[YEAR], r[MONTH]) for r in read_table(spark, path).collect())
    assert got == [("E", 2020, 2), ("I", 2019, 1)]
    with pytest.raises(ValueError, match="without rows"):
        upsert_table(make_trade(spark, []), path, full=True)
    assert read_table(spark, path).count() == 2


def test_null_years_stay(spark):
    path = scratch_path(spark, "t")
    upsert_table(make_trade(spark, [("E", "A", "B", "3101", None, 1, 1.0, 1.0)]), path)
    assert read_table(spark, path).count() == 1
    upsert_table(make_trade(spark, [("E", "A", "C", "3101", None, 1, 1.0, 2.0),
                                    ("E", "A", "C", "3101", 2020, 1, 1.0, 3.0)]), path)
    upsert_table(make_trade(spark, [("E", "A", "B", "3101", None, 1, 1.0, 4.0)]), path)
    got = sorted((str(r[YEAR]), r.PARTNER, r[QTY1]) for r in read_table(spark, path).collect())
    assert got == [("2020", "C", 3.0), ("None", "B", 4.0), ("None", "C", 2.0)]


def test_half_done_commit_is_finished(spark, monkeypatch):
    """The job dies in the middle of carrying its note out; the next run finishes it."""
    path = scratch_path(spark, "t")
    upsert_table(make_trade(spark, [("E", "A", p, "3101", y, 1, 1.0, 1.0) for p in "BC" for y in (2019, 2020)]), path)
    move, moved = files.move, []

    def dies(*a):
        if moved:
            raise KeyboardInterrupt
        moved.append(move(*a))

    monkeypatch.setattr(files, "move", dies)
    with pytest.raises(KeyboardInterrupt):
        upsert_table(make_trade(spark, [("E", "A", "B", "3101", y, 1, 1.0, 7.0) for y in (2019, 2020)]), path)
    monkeypatch.setattr(files, "move", move)
    assert not commits.last(spark, path)["done"]
    upsert_table(make_trade(spark, [("E", "A", "D", "3101", 2021, 1, 1.0, 2.0)]), path)
    assert sorted((r.PARTNER, r[QTY1]) for r in read_table(spark, path).collect()) == [("B", 7.0), ("B", 7.0), ("C", 1.0), ("C", 1.0), ("D", 2.0)]
    assert files.children(spark, f"{path}/{commits.RUNS}") == []


def test_job_lost_before_its_commit_changes_nothing(spark, monkeypatch):
    path = scratch_path(spark, "t")
    upsert_table(make_trade(spark, [("E", "A", "B", "3101", 2020, 1, 1.0, 1.0)]), path)
    with monkeypatch.context() as m:
        m.setattr(commits, "commit", lambda *a, **k: (_ for _ in ()).throw(KeyboardInterrupt))
        with pytest.raises(KeyboardInterrupt):
            upsert_table(make_trade(spark, [("E", "A", "B", "3101", 2020, 1, 1.0, 9.0)]), path)
    assert [r[QTY1] for r in read_table(spark, path).collect()] == [1.0]
    assert len(files.children(spark, f"{path}/{commits.RUNS}")) == 1
    commits.sweep(spark, path)
    assert len(files.children(spark, f"{path}/{commits.RUNS}")) == 1      # not old enough
    commits.sweep(spark, path, hours=-1)
    assert files.children(spark, f"{path}/{commits.RUNS}") == []


def test_a_version_is_taken_once(spark):
    path = scratch_path(spark, "t")
    assert files.create(spark, f"{path}/a", "one") and not files.create(spark, f"{path}/a", "two")
    assert files.read_text(spark, f"{path}/a") == "one" and files.children(spark, path) == ["a"]


@pytest.mark.parametrize("other", [("I", "A", "X", "3101", 2020, 1, 1.0, 5.0), ("E", "A", "X", "3101", 2020, 1, 1.0, 5.0), ("E", "A", "X", "3101", 2021, 1, 1.0, 5.0)])
def test_interleaved_runs(spark, monkeypatch, other):
    """A second run starts and ends between the merge and the commit of the first:
    on another flow, on the same partition, on a partition that was new to both."""
    path, commit, merges, begun = scratch_path(spark, "t"), commits.commit, [], []
    upsert_table(make_trade(spark, [("E", "A", "B", "3101", 2020, 1, 1.0, 1.0), ("I", "A", "B", "3101", 2020, 1, 1.0, 1.0)]), path)

    def late(*a, **k):
        if not begun:
            begun.append(1)
            upsert_table(make_trade(spark, [other]), path)
        merges.append(1)
        return commit(*a, **k)

    monkeypatch.setattr(commits, "commit", late)
    upsert_table(make_trade(spark, [("E", "A", "C", "3101", y, 1, 1.0, 3.0) for y in (2020, 2021)]), path)
    got = sorted((r.FLOW, r.PARTNER, r[YEAR], r[QTY1]) for r in read_table(spark, path).collect())
    want = [("E", "B", 2020, 1.0), ("I", "B", 2020, 1.0), ("E", "C", 2020, 3.0), ("E", "C", 2021, 3.0), (other[0], "X", other[4], 5.0)]
    assert got == sorted(want)
    assert len(merges) == (2 if other[0] == "I" else 3)     # merged again only where both met


def test_a_slow_run_meets_its_commit_carried_out(spark, monkeypatch):
    """Another run finishes the first one's commit, and commits itself, while the
    first is still carrying its own out."""
    path, carry, begun = scratch_path(spark, "t"), commits.carry_out, []
    upsert_table(make_trade(spark, [("E", "A", "B", "3101", 2020, 1, 1.0, 1.0)]), path)

    def slow(*a):
        if not begun:
            begun.append(1)
            upsert_table(make_trade(spark, [("E", "A", "D", "3101", 2020, 1, 1.0, 4.0)]), path)
        return carry(*a)

    monkeypatch.setattr(commits, "carry_out", slow)
    upsert_table(make_trade(spark, [("E", "A", "C", "3101", 2020, 1, 1.0, 3.0)]), path)
    assert sorted((r.PARTNER, r[QTY1]) for r in read_table(spark, path).collect()) == [("B", 1.0), ("C", 3.0), ("D", 4.0)]


def test_runs_in_threads_lose_no_row(spark):
    from concurrent.futures import ThreadPoolExecutor
    path = scratch_path(spark, "t")
    batches = [make_trade(spark, [("EI"[i % 2], "A", f"P{i}", "3101", y, 1, 1.0, float(i)) for y in (2020, 2021)]) for i in range(6)]
    with ThreadPoolExecutor(3) as pool:
        list(pool.map(lambda b: upsert_table(b, path), batches))
    got = sorted((r.PARTNER, r[YEAR], r[QTY1]) for r in read_table(spark, path).collect())
    assert got == sorted((f"P{i}", y, float(i)) for i in range(6) for y in (2020, 2021))
    note = commits.last(spark, path)
    assert note["version"] == 6 and commits.flow_rows(note["partitions"]) == {"E": 6, "I": 6}


def test_record_and_audit_without_counting(spark):
    from tradelens.operators.load import load_audit
    from tradelens.sources.table import record_of, recorded_audit
    path = scratch_path(spark, "t")
    old = make_trade(spark, [("E", "A", p, "3101", y, 1, 1.0, 1.0) for p in "BC" for y in (2019, 2020)])
    new = make_trade(spark, [("E", "A", "B", "3101", 2020, 1, 1.0, 2.0)] * 2 + [("I", "A", "B", "3101", 2020, 1, 1.0, 2.0)])
    upsert_table(old, path)
    upsert_table(new, path)
    counted = load_audit(old, new, read_table(spark, path))
    key = sorted(counted.columns)
    assert sorted(map(tuple, recorded_audit(spark, path).select(key).collect())) == sorted(map(tuple, counted.select(key).collect()))
    assert sorted(tuple(r)[:4] for r in record_of(spark, path).collect()) == [("E", 2019, 2, 1), ("E", 2020, 2, 2), ("I", 2020, 1, 2)]


def test_table_without_notes_is_adopted(spark):
    path = scratch_path(spark, "t")
    write_table(make_trade(spark, [("E", "A", "B", "3101", y, 1, 1.0, 1.0) for y in (2019, 2020)]), path)
    upsert_table(make_trade(spark, [("E", "A", "B", "3101", 2020, 1, 1.0, 5.0)]), path)
    assert sorted((r[YEAR], r[QTY1]) for r in read_table(spark, path).collect()) == [(2019, 1.0), (2020, 5.0)]
    fresh = {r.FLOW: r for r in table_freshness(spark, path).collect()}
    assert (fresh["E"].N_PARTITIONS, fresh["E"].ROWS, fresh["E"].N_STRANGE) == (2, 2, 1)     # 2019 has no recorded write


def test_batch_is_written_once(spark):
    """New partitions take the batch's files as they are; only stored ones are merged."""
    path = scratch_path(spark, "t")
    rows = [("E", "A", "B", "3101", y, 1, 1.0, 1.0) for y in (2019, 2020)]
    note = upsert_table(make_trade(spark, rows), path)
    assert all(f.startswith("fresh/") for c in note["changes"].values() for f in c["add"])
    note = upsert_table(make_trade(spark, [("E", "A", "C", "3101", y, 1, 1.0, 1.0) for y in (2020, 2021)]), path)
    kinds = {p: [f.split("/")[0] for f in c["add"]] for p, c in note["changes"].items()}
    assert kinds == {"FLOW=E/YEAR=2020": ["merged-1"], "FLOW=E/YEAR=2021": ["fresh"]}


def test_upsert_plan_leaves_stored_rows_unsorted(spark):
    path = scratch_path(spark, "t")
    upsert_table(make_trade(spark, [("E", "A", "B", "3101", 2020, 1, 1.0, 1.0)]), path)
    out = upsert_keep_last(read_table(spark, path), make_trade(spark, [("E", "A", "B", "3101", 2020, 1, 1.0, 2.0)]),
                           old_unique=True)
    assert out.count() == 1
    assert "SortAggregate" not in out._jdf.queryExecution().executedPlan().toString()


def test_stored_files_are_sorted(spark):
    path = scratch_path(spark, "t")
    rows = [("E", r, p, "3101", y, 1, 1.0, 1.0) for r in "CAB" for p in "ZYX" for y in (2020, 2019)]
    write_table(make_trade(spark, rows), path)
    for f in spark.read.parquet(path).inputFiles():
        got = [(r.REPORTER, r.PARTNER) for r in spark.read.parquet(f).collect()]
        assert len(got) == 9 and got == sorted(got)


def test_later_file_wins(spark):
    """Larger later file, later file of another encoding."""
    root = scratch_path(spark, "land")
    row = "A\tB\t3101\t2020\t1\t1\t{}\n"
    fill = "".join(f"A\tP{i}\t3101\t2020\t1\t1\t0\n" for i in range(500))
    land(root, "b_old.tsv", HEAD + row.format(1), at=1_600_000_000)
    land(root, "a_new.tsv", HEAD + fill + row.format(2), at=1_600_000_100)
    out = keep_last(extract.read_extracts(spark, root, "E", arrival=True)).where("PARTNER = 'B'").collect()
    assert [r[QTY1] for r in out] == [2.0]
    land(root, "c_newest.tsv", HEAD + row.format(3), "utf-16", at=1_600_000_200)
    out = keep_last(extract.read_extracts(spark, root, "E", arrival=True)).where("PARTNER = 'B'").collect()
    assert [r[QTY1] for r in out] == [3.0]


def test_later_file_wins_inside_a_micro_batch(spark):
    landing, path = scratch_path(spark, "land"), scratch_path(spark, "t")
    row = [("E", "A", "B", "3101", 2020, 1, 1.0, 1.0)]
    make_trade(spark, row).coalesce(1).write.mode("append").parquet(landing)
    time.sleep(1.1)
    more = [("E", "A", f"P{i}", "3101", 2020, 1, 1.0, 0.0) for i in range(500)]
    make_trade(spark, [("E", "A", "B", "3101", 2020, 1, 1.0, 2.0), *more]).coalesce(1).write.mode("append").parquet(landing)
    stream_upsert(spark, landing, path, scratch_path(spark, "ck"), TRADE_SCHEMA)
    got = read_table(spark, path)
    assert got.count() == 501 and got.where("PARTNER = 'B'").first()[QTY1] == 2.0


def test_columns_by_name_in_every_file(spark):
    root = scratch_path(spark, "land")
    land(root, "a.tsv", HEAD + "A\tB\t3101\t2020\t1\t5\t6\n")
    land(root, "b.tsv", "PARTNER\tREPORTER\tCOMMODITY\tYEAR\tMONTH\tQTY1\tVALUE\tNOTE\nB2\tA2\t3101\t2020\t1\t6\t5\tx\n")
    got = sorted((r.REPORTER, r.PARTNER, r.VALUE, r[QTY1]) for r in extract.read_extracts(spark, root, "E").collect())
    assert got == [("A", "B", 5.0, 6.0), ("A2", "B2", 5.0, 6.0)]
    land(root, "c.tsv", "PARTNER\tREPORTER\tCOMMODITY\tYEAR\tMONTH\nB\tA\t3101\t2020\t1\n")
    with pytest.raises(ValueError, match="QTY1"):
        extract.read_extracts(spark, root, "E")


def test_short_row_stops_and_quoted_break_is_kept(spark):
    root = scratch_path(spark, "land")
    land(root, "a.tsv", HEAD + "A\t\"B\nand C\"\t3101\t2020\t1\t5\t6\nA\tD\t3101\t2020\t2\t5\t7\n")
    got = sorted((r.PARTNER, r[QTY1]) for r in extract.read_extracts(spark, root, "E").collect())
    assert got == [("B\nand C", 6.0), ("D", 7.0)]
    bad = scratch_path(spark, "land")
    land(bad, "a.tsv", HEAD + "A\tB\t3101\t2020\n")
    with pytest.raises(Exception, match="(?i)malformed"):
        extract.read_extracts(spark, bad, "E").collect()


def plain_rows(text):
    """Records of an extract by a reader of the whole text."""
    import csv
    import io
    rows = list(csv.reader(io.StringIO(text, newline=""), delimiter="\t"))
    return sorted((r[0], r[1], float(r[6])) for r in rows[1:] if any(r))


def quoted_text(seed, n=100):
    """Fields with line breaks, doubled quotes, tabs inside quotes, quotes inside plain fields."""
    import random
    rng, out = random.Random(seed), HEAD
    for i in range(n):
        name = rng.choice([f"P{i}", f'"P{i}\nin two"', f'"P ""{i}"" q"', f'"tab\there {i}"', f'5" pipe {i}', f'"a\n\nb\n""c""\n{i}"', "\u0100\u0a05\u0100x", "\u00c9"])
        out += f'"R{i}"\t{name}\t3101\t2020\t{i % 12 + 1}\t1\t{i}\n'
    return out


@pytest.mark.parametrize("encoding", ["utf-8", "utf-16-le", "utf-16-be", "latin-1"])
@pytest.mark.parametrize("size", ["300b", "128m"])
def test_quoted_breaks_and_utf16_in_splits(spark, encoding, size):
    text = quoted_text(3)
    if encoding in ("latin-1", "utf-16-be"):
        text = text.replace("\u0100\u0a05\u0100x", "y")
    root = scratch_path(spark, "land")
    land(root, "a.tsv", ("\ufeff" if "16" in encoding else "") + text, encoding)
    spark.conf.set("spark.sql.files.maxPartitionBytes", size)
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        if "16" in encoding:        # this text has line-end bytes at odd places
            assert [r.MODE for r in extract.inspect_files(spark, root).collect()] == [extract.WHOLE if encoding == "utf-16-le" else extract.RECORDS]
        got = extract.read_extracts(spark, root, "E").select("REPORTER", "PARTNER", QTY1).collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert sorted(map(tuple, got)) == plain_rows(text)


@pytest.mark.parametrize("encoding, quoted", [("utf-16-le", False), ("utf-16-be", False), ("utf-16-le", True), ("utf-8", True)])
def test_large_files_are_read_by_several_tasks(spark, encoding, quoted):
    body = "".join(f"R{i}\t" + (f'"P{i}\nx"' if quoted and i % 50 == 0 else f"P{i}") + f"\t3101\t2020\t1\t1\t{i}\r\n" for i in range(2000))
    root = scratch_path(spark, "land")
    land(root, "a.tsv", ("\ufeff" if "16" in encoding else "") + HEAD + body, encoding)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16k")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        mode = extract.inspect_files(spark, root).first().MODE
        lines = extract._lines(spark, root, encoding.upper().replace("16-", "16"))
        assert lines.rdd.getNumPartitions() > 3 and mode == (extract.RECORDS if quoted else extract.LINES)
        df = extract.read_extracts(spark, root, "E", arrival=True)
        assert "multiLine" not in df._jdf.queryExecution().toString()
        got = sorted((r.REPORTER, r.PARTNER, r[QTY1]) for r in df.collect())
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert got == sorted((f"R{i}", f"P{i}\nx" if quoted and i % 50 == 0 else f"P{i}", float(i)) for i in range(2000))


def test_kinds_of_files_share_folders(spark):
    """Folders of one kind are read as folders, mixed ones file by file."""
    root = scratch_path(spark, "land")
    line = "A\t{}\t3101\t2020\t1\t5\t6\n"
    for i in range(3):
        land(f"{root}/one", f"{i}.tsv", HEAD + line.format(f"u{i}"))
    land(f"{root}/two", "a.tsv", HEAD + line.format("\u00e9"), "latin-1")
    land(f"{root}/two", "b.tsv", HEAD + line.format("plain"))
    land(f"{root}/two", "c.tsv", HEAD + line.format('"q\nr"'))
    files = extract.inspect_files(spark, f"{root}/*")
    assert sorted(r.MODE for r in files.collect()) == ["lines"] * 5 + ["records"]
    assert len(extract._paths(files.where("ENCODING = 'UTF-8' AND MODE = 'lines'"), files)) == 2
    got = sorted(r.PARTNER for r in extract.read_extracts(spark, f"{root}/*", "E").collect())
    assert got == sorted(["u0", "u1", "u2", "\u00e9", "plain", "q\nr"])


def test_cotton_ingest_low_water_and_full(spark):
    from tradelens.dims import reference_dims
    from tradelens.sources.ingest import ingest
    dims = reference_dims(spark, "cotton", "E")
    root, path = scratch_path(spark, "land"), scratch_path(spark, "t")
    head = "\t".join(COTTON_COLUMNS) + "\n"
    land(f"{root}/1", "a.tsv", head + "".join(f"Brazil\tChina\t5201\t{y}\t1\t{y}\n" for y in (2019, 2020)))
    land(f"{root}/2", "a.tsv", head + "".join(f"Brazil\tChina\t5201\t{y}\t1\t1\n" for y in (2019, 2020, 2021)))
    a = ingest(spark, f"{root}/1", path, "E", dims, columns=COTTON_COLUMNS).first()
    assert (a.ROWS_BEFORE, a.ROWS_FETCHED, a.ROWS_AFTER) == (0, 2, 2)
    a = ingest(spark, f"{root}/2", path, "E", dims, columns=COTTON_COLUMNS).first()
    assert (a.ROWS_BEFORE, a.ROWS_FETCHED, a.ROWS_AFTER, a.ROWS_NEW) == (2, 2, 3, 1)
    got = sorted((r[YEAR], r[QTY1], r.REGION) for r in read_table(spark, path).collect())
    assert got == [(2019, 2019.0, "Asia"), (2020, 1.0, "Asia"), (2021, 1.0, "Asia")]


def test_old_layout_and_freshness(spark):
    old = make_trade(spark, [("E", "A", "B", "3101", 2020, 3, 1.0, 1.0)]).withColumnRenamed(MONTH, "MONTH_NUM") \
        .withColumn("HS4_TAG", F.lit("t"))
    r = normalise(old).first()
    assert (r[MONTH], r.COMMODITY_TAG, r.REPORTER_REGION) == (3, "t", "Other")
    path = scratch_path(spark, "t")
    before = time.time() - 2
    upsert_table(make_trade(spark, [("E", "A", "B", "3101", y, 3, 1.0, 1.0) for y in (2019, 2020)]), path)
    fresh = table_freshness(spark, path).first()
    assert before <= fresh.LAST_MODIFIED.timestamp() <= time.time() + 2
    assert fresh.IS_DATED and (fresh.N_PARTITIONS, fresh.ROWS) == (2, 2)
    part = f"{path}/FLOW=E/YEAR=2020"
    files.set_time(spark, f"{part}/{commits.data_files(spark, part)[0]}", 1_000_000_000_000)     # an old file put back
    fresh = table_freshness(spark, path).first()
    assert not fresh.IS_DATED and fresh.N_STRANGE == 1 and fresh.LAST_MODIFIED.timestamp() > before


def test_cluster_without_shared_folder_is_refused():
    from types import SimpleNamespace
    from tradelens.session import checkpoint_root
    conf = SimpleNamespace(get=lambda *a: None)
    sc = SimpleNamespace(master="spark://host:7077", getCheckpointDir=lambda: None, getConf=lambda: conf)
    with pytest.raises(RuntimeError, match="shared folder"):
        checkpoint_root(SimpleNamespace(sparkContext=sc, conf=conf))

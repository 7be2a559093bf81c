"""CSV records with open quotes, short and surplus cells, against a reader that goes line by line."""

import random

import pytest

from rosterweave.plans.staging import Stage
from rosterweave.sources import csv_records


def ends_as(lines):
    """How text that begins outside a cell ends, and its cells; character by character."""
    text, cells, i = "\n".join(lines), [], 0
    while True:
        if text[i : i + 1] == '"':
            i += 1
            held = ""
            while True:
                if i >= len(text):
                    return "open", None
                if text[i] == '"' and text[i + 1 : i + 2] == '"':
                    held += '"'
                    i += 2
                elif text[i] == '"':
                    i += 1
                    break
                else:
                    held += text[i]
                    i += 1
            cells.append(held)
            if i < len(text) and text[i] != ",":
                return "bad", None
        else:
            end = text.find(",", i)
            end = len(text) if end < 0 else end
            cells.append(text[i:end])
            i = end
        if i >= len(text):
            return "closed", cells
        i += 1


def line_by_line(lines, n):
    """Records (cells) and dead letters (error, text) of the lines behind the header."""
    good, dead, i = [], [], 0
    while i < len(lines):
        state, cells = ends_as([lines[i]])
        if not lines[i].strip(" "):
            i += 1
            continue
        if state == "open":
            j = i
            while state == "open" and j + 1 < len(lines):
                j += 1
                state, cells = ends_as(lines[i : j + 1])
            if state == "closed" and len(cells) == n:
                good.append(cells)
                i = j + 1
                continue
            dead.append((csv_records.OPEN, lines[i]))
        elif state == "bad":
            dead.append((csv_records.JUNK, lines[i]))
        elif len(cells) != n:
            dead.append((f"Expected {n} cells, found {len(cells)}", lines[i]))
        else:
            good.append(cells)
        i += 1
    return good, dead


def read(spark, path, columns, stage, **more):
    parsed = Stage(spark, stage.folder)(csv_records.parse_csv(spark, str(path), columns, stage, **more), "parsed")
    rows = parsed.orderBy("ingest_ordinal").collect()
    good = [[r[c] for c in columns] for r in rows if r.error is None]
    return good, [(r.error, r.raw_record) for r in rows if r.error is not None]


def test_rows_behind_an_open_quote_are_kept(spark, stage, tmp_path):
    path = tmp_path / "in" / "staff.csv"
    path.parent.mkdir()
    path.write_text('id,name,note\n1,Ann,x\n2,"Lee,y\n3,"O ""Hara",z\n4,"two\nlines, here",\r\n5,a,b,c\n6,a\n7,"x"y,b\n\n8,5" pipe,"end"\n')
    good, dead = read(spark, path, ["id", "name", "note"], stage)
    assert good == [
        ["1", "Ann", "x"], ["3", 'O "Hara', "z"], ["4", "two\nlines, here", None], ["8", '5" pipe', "end"],
    ]
    assert dead == [
        (csv_records.OPEN, 'staff.csv: 2,"Lee,y'), ("Expected 3 cells, found 4", "staff.csv: 5,a,b,c"),
        ("Expected 3 cells, found 2", "staff.csv: 6,a"), (csv_records.JUNK, 'staff.csv: 7,"x"y,b'),
    ]


def test_an_open_quote_in_the_last_record_and_in_the_same_column_twice(spark, stage, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.csv").write_text('id,name\n1,"Lee\n2,b\n3,"Jon\n4,d\n5,"last')
    good, dead = read(spark, tmp_path / "in", ["id", "name"], stage)
    assert good == [["2", "b"], ["4", "d"]]
    assert [d[1] for d in dead] == ['a.csv: 1,"Lee', 'a.csv: 3,"Jon', 'a.csv: 5,"last']


@pytest.mark.parametrize("seed,block", [(1, 1), (2, 2), (3, 13)])
def test_random_lines_equal_a_reader_line_by_line(spark, stage, tmp_path, monkeypatch, seed, block):
    monkeypatch.setattr(csv_records, "_BLOCK", block)
    rnd = random.Random(seed)
    (tmp_path / "in").mkdir()
    want_good, want_dead = [], []
    for f in range(25):
        n = rnd.randint(1, 3)
        names = ["a", "b", "c"][:n]
        weights = rnd.choice([[6, 2, 2, 1], [3, 4, 3, 1], [4, 3, 0, 2]])
        lines = ["".join(rnd.choices('xy",'[1:] + " ", weights, k=rnd.randint(0, 7))) for _ in range(60)]
        (tmp_path / "in" / f"{f:02}.csv").write_bytes(("\n".join([",".join(["a", "b", "c"][:n]), *lines])).encode())
        good, dead = line_by_line(lines, n)
        want_good += [[*c, *[None] * (3 - n)] for c in good]
        want_dead += [(e, f"{f:02}.csv: {t}") for e, t in dead]
        assert names
    monkeypatch.setattr(csv_records, "MISSING_CELLS", [])
    parsed = csv_records.parse_csv(spark, str(tmp_path / "in"), ["a"], stage)
    spans = Stage(spark, stage.folder)(parsed, "parsed").collect()
    assert sorted(r.a for r in spans if r.error is None) == sorted(c[0] for c in want_good)
    assert sorted((r.error, r.raw_record) for r in spans if r.error) == sorted(want_dead)
    assert any("\n" in c[0] for c in want_good) and any(e == csv_records.OPEN for e, _ in want_dead)


def test_large_files_are_split_and_keep_their_order(spark, stage, tmp_path):
    path = tmp_path / "big.csv"
    body = "".join(
        f'{i},"F\n{i}",x\n' if i % 7 == 0 else f'{i},"open,x\n' if i % 501 == 0 else f"{i},F,x\n" for i in range(4000)
    )
    path.write_text("id,name,z\n" + body)
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", 8000)
        spark.conf.set("spark.sql.files.openCostInBytes", 1000)
        good, dead = read(spark, path, ["id", "name"], stage)
        parts = spark.read.parquet(f"{stage.folder}/csv_lines").selectExpr("shiftright(at, 33)").distinct().count()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert parts > 3
    open_ = [i for i in range(4000) if i % 501 == 0 and i % 7]
    assert [int(g[0]) for g in good] == [i for i in range(4000) if i not in open_]
    assert all(g[1] == (f"F\n{g[0]}" if int(g[0]) % 7 == 0 else "F") for g in good)
    assert [d[0] for d in dead] == [csv_records.OPEN] * len(open_)


def test_every_line_is_a_record_without_multiline(spark, stage, tmp_path):
    path = tmp_path / "a.csv"
    path.write_text('﻿"id",name\n1,"a\nb"\n2,c\n', encoding="utf-8")
    good, dead = read(spark, path, ["id", "name"], stage, multiline=False)
    assert good == [["2", "c"]]
    assert dead == [(csv_records.OPEN, 'a.csv: 1,"a'), ("Expected 2 cells, found 1", 'a.csv: b"')]


def test_empty_files_and_headers_alone(spark, stage, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.csv").write_text("")
    (tmp_path / "in" / "b.csv").write_text("id,name\n")
    (tmp_path / "in" / "c.csv").write_text("\n \nname,id\nx,1\n")
    assert read(spark, tmp_path / "in", ["id", "name"], stage) == ([["1", "x"]], [])

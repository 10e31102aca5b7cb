"""CSV records over split borders, against Spark's own reader of whole files and against a plain state machine."""

import random

import pytest
from pyspark.sql import functions as F

from wayword.sources import records
from wayword.sources.records import quote_state, read_csv_records, read_records


def slow_state(inside, line, sep, quote, escape):
    """Character by character."""
    state = "quoted" if inside else "start"
    i = 0
    while i < len(line):
        c = line[i]
        if state == "quoted":
            if escape != quote and c == escape and line[i + 1 : i + 2] in (quote, escape):
                i += 1
            elif c == quote and escape == quote and line[i + 1 : i + 2] == quote:
                i += 1
            elif c == quote:
                state = "plain"
        elif c == sep:
            state = "start"
        elif state == "start" and c == quote:
            state = "quoted"
        else:
            state = "plain"
        i += 1
    return state == "quoted"


@pytest.mark.parametrize("escape", ['"', "\\"])
def test_quote_state(escape):
    rnd = random.Random(4)
    after = quote_state(escape=escape)
    for _ in range(4000):
        line = "".join(rnd.choice('aa,"" \\') for _ in range(rnd.randrange(14)))
        for inside in (False, True):
            assert after(inside, line) == slow_state(inside, line, ",", '"', escape), (inside, line)
    many = f'{escape}"' * 50_000
    assert after(False, f'"{many}x,') and not after(True, f'{many}"')


def write(path, text):
    path.write_bytes(text.encode())
    return str(path)


@pytest.fixture
def small_splits(spark):
    kept = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "150")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    yield
    for k, v in kept.items():
        spark.conf.set(k, v)


def nasty_text(rnd, n, escape):
    field = ["plain", "", '5 inch" pipe', "ä  ö", " led", "tail ", "\\ slash" if escape == '"' else "x"]
    quoted = ["", "one, two", "line\nbreak", "\n\nmany\n\n", "dos\r\nbreak", "\U0001f600", "x" * 200 + "\n" + "y" * 150, ",\n,\n,"]
    quoted += ['say ""hi""\n', '""'] if escape == '"' else ['say \\"hi\\"\n', "back\\\\"]
    rows = ['id,"first\nname",b,c']
    for i in range(n):
        cells = [rnd.choice(field) if rnd.random() < 0.5 else '"' + rnd.choice(quoted) + '"' for _ in range(rnd.choice([3, 3, 3, 2, 4]))]
        rows.append(",".join([str(i), *cells]))
        if rnd.random() < 0.1:
            rows.append("")
    return rows


@pytest.mark.parametrize("escape", ['"', "\\"])
@pytest.mark.parametrize("shuffled", [False, True])
def test_records_over_split_borders(spark, tmp_path, small_splits, monkeypatch, escape, shuffled):
    if shuffled:
        monkeypatch.setattr(records, "BROADCAST_ROWS", 0)
    rnd = random.Random(9)
    first, second = nasty_text(rnd, 40, escape), nasty_text(rnd, 30, escape)
    for folder, end in (("mixed", "\r\n"), ("plain", "\n")):
        (tmp_path / folder).mkdir()
        write(tmp_path / folder / "a.csv", "\n".join(first) + "\n")
        # Records may end with a carriage return too, which Spark's reader leaves in the last field.
        write(tmp_path / folder / "b.csv", end.join(second))
        write(tmp_path / folder / "c.csv", 'id,"first\nname",b,c\n')
    options = {"header": True, "multiLine": True, "escape": escape}
    want = spark.read.options(**options).csv(str(tmp_path / "plain"))
    got = read_csv_records(spark, str(tmp_path / "mixed"), escape=escape)
    assert got.columns == want.columns == ["id", "first\nname", "b", "c"]
    lines = records.numbered_lines(spark, str(tmp_path / "mixed"))
    assert lines.select("file", "block").distinct().count() > 10
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(map(tuple, want.collect()), key=repr)


def test_a_field_over_many_splits_and_an_open_quote(spark, tmp_path, small_splits):
    long = "\n".join(f"line {i}, with \"\"marks\"\"" for i in range(40))
    write(tmp_path / "long.csv", f'h\n1\n"{long}"\n2\n')
    got = [r[0] for r in read_csv_records(spark, str(tmp_path / "long.csv")).collect()]
    assert sorted(got) == sorted(["1", long.replace('""', '"'), "2"])
    write(tmp_path / "open.csv", 'h\n1\n"' + "never closed\n" * 30)
    got = [r[0] for r in read_records(spark, str(tmp_path / "open.csv")).collect()]
    assert sorted(got) == sorted(["h", "1", '"' + "never closed\n" * 29 + "never closed"])


def test_an_empty_file_and_only_a_header(spark, tmp_path):
    write(tmp_path / "none.csv", "")
    assert read_records(spark, str(tmp_path / "none.csv")).count() == 0
    write(tmp_path / "head.csv", "a,b\n")
    got = read_csv_records(spark, str(tmp_path / "head.csv"))
    assert got.columns == ["a", "b"] and got.count() == 0
    assert got.where(F.col("a") == "x").count() == 0

"""Reading TSV records in blocks."""

import random

import pyarrow as pa
import pytest
from pyspark.sql import functions as F, types as T

from chunkspark import export_tsv, import_tsv
from chunkspark.sources import tsv_records
from chunkspark.sources.tsv_records import PLAIN, QUOTED, START, MalformedRecordError, after, fields, read_values

SETTING = "spark.sql.files.maxPartitionBytes"


@pytest.fixture(params=[64, 700, 1 << 27])
def block(spark, request):
    before = spark.conf.get(SETTING)
    spark.conf.set(SETTING, request.param)
    yield request.param
    spark.conf.set(SETTING, before)


def walk(data):
    """State at the end, byte by byte: (begins a value, inside quotes, after quotes, plain; escaped)."""
    mode, escaped = "begin", False
    for c in data.decode("latin-1"):
        if escaped:
            escaped = False
        elif c == "\\" and mode != "after":
            escaped, mode = True, "plain" if mode == "begin" else mode
        elif c == '"' and mode in ("begin", "quoted"):
            mode = "quoted" if mode == "begin" else "after"
        elif c == "\t" and mode != "quoted":
            mode = "begin"
        elif mode == "begin":
            mode = "plain"
    return QUOTED if mode == "quoted" else PLAIN if escaped else START


def test_states_of_lines_equal_a_walk_over_bytes():
    draw = random.Random(2)
    for _ in range(20_000):
        line = bytes(draw.choice(b'"\\\tab') for _ in range(draw.randrange(9)))
        for state, opening in ((START, b""), (QUOTED, b'"'), (PLAIN, b"x")):
            assert after(state, line) == walk(opening + line), (state, line)


def test_fields():
    assert fields(rb'1	\N	"\\N"	""		a\\b	"x\"	y"') == [b"1", None, rb"\N", b"", b"", rb"a\b", b'x"\ty']
    assert fields(rb'5" disk	"a"	\N\N	c\	d	e\q') == [b'5" disk', b"a", rb"\N\N", b"c\td", rb"e\q"]
    assert fields(b"") == [b""] and fields(b"\t") == [b"", b""]
    with pytest.raises(MalformedRecordError, match="after the end"):
        fields(b'"a"b\t1')


def rows_of(draw, count):
    cells = ["\\N", "\\\\N", '"', "\\", "\n", "\t", "a", "\n\n", '"\n"', "\\\n", "long " * 60, "ü", "\r", '\t"']
    text = lambda: None if draw.random() < 0.1 else "".join(draw.choice(cells) for _ in range(draw.randrange(1, 6)))
    return [(i, text(), bytearray((text() or "-").encode() + bytes([255, 0, i % 256])), None if i % 7 == 0 else i / 3, text()) for i in range(count)]


def same(a, b):
    return sorted(map(str, a.collect())) == sorted(map(str, b.collect()))


@pytest.mark.parametrize("files", [1, 3])
def test_any_text_in_blocks_of_any_size(spark, tmp_path, block, files):
    draw = random.Random(files)
    rows = spark.createDataFrame(rows_of(draw, 150), "i long, t string, b binary, d double, u string").repartition(files)
    export_tsv(rows, f"{tmp_path}/t")
    back = import_tsv(spark, f"{tmp_path}/t", rows.schema)
    assert same(back, rows)
    if block == 64:
        assert spark.read.text(f"{tmp_path}/t").rdd.getNumPartitions() > 50


def test_a_value_over_many_blocks(spark, tmp_path, block):
    rows = spark.createDataFrame([(1, "x"), (2, "line\n" * 500 + '"\\'), (3, "\\N"), (4, "\n" * 300), (5, None)], "i long, t string")
    export_tsv(rows.coalesce(1), f"{tmp_path}/t")
    assert same(import_tsv(spark, f"{tmp_path}/t", rows.schema), rows)


def test_blocks_too_many_to_send(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(tsv_records, "BROADCAST_ROWS", -1)
    spark.conf.set(SETTING, 100)
    try:
        rows = spark.createDataFrame(rows_of(random.Random(8), 60), "i long, t string, b binary, d double, u string").coalesce(1)
        export_tsv(rows, f"{tmp_path}/t")
        assert same(import_tsv(spark, f"{tmp_path}/t", rows.schema), rows)
    finally:
        spark.conf.set(SETTING, 1 << 27)


def test_files_of_others(spark, tmp_path, block):
    (tmp_path / "f.tsv").write_bytes(b'1\t5" disk\n2\t\\N\n3\t"a\nb"\n4\tescaped\\\nline\n5\t""\n6\t\n7\tno end')
    schema = T.StructType().add("i", "long").add("t", "string")
    got = {r.i: r.t for r in import_tsv(spark, f"{tmp_path}/f.tsv", schema).collect()}
    assert got == {1: '5" disk', 2: None, 3: "a\nb", 4: "escaped\nline", 5: "", 6: "", 7: "no end"}


@pytest.mark.parametrize("data, told", [
    (b'1\t2\n"open\n' + b"more\n" * 40, "without an end"), (b"1\t2\t3\n", "3 values for 2"), (b"1\n", "1 values for 2"), (b'1\t"a"b\n', "after the end"),
    (b"one\t2\n", "no bigint for column i"),
])
def test_malformed_files_are_refused(spark, tmp_path, block, data, told):
    (tmp_path / "f.tsv").write_bytes(data)
    with pytest.raises(Exception, match=told):
        import_tsv(spark, f"{tmp_path}/f.tsv", T.StructType().add("i", "long").add("t", "string")).collect()


def test_lines_as_records(spark, tmp_path, block):
    rows = spark.range(300).selectExpr("id AS i", "concat('v', id) AS t")
    export_tsv(rows.coalesce(1), f"{tmp_path}/t")
    assert same(import_tsv(spark, f"{tmp_path}/t", rows.schema, multi_line=False), rows)


def test_empty_files(spark, tmp_path):
    (tmp_path / "f.tsv").write_bytes(b"")
    assert read_values(spark, f"{tmp_path}/f.tsv", 2).collect() == []


def test_instants_are_written_in_utc(spark, tmp_path):
    rows = spark.sql("SELECT timestamp_seconds(1636263000 + 3600 * id) AS at FROM range(2)")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        export_tsv(rows, f"{tmp_path}/t")
        assert same(import_tsv(spark, f"{tmp_path}/t", rows.schema).select(F.unix_micros("at")), rows.select(F.unix_micros("at")))
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def block_of(lines, *more):
    columns = [pa.array([7] * len(lines)), pa.array([0] * len(lines)), *more, pa.array(lines, pa.binary())]
    return pa.RecordBatch.from_arrays(columns, names=[f"x{i}" for i in range(len(columns))])


def test_simple_lines_are_whole_records():
    draw = random.Random(11)
    values = [b"1", b"\\N", b'"a b"', b'""', b"", b'"\\N"', b"\\", b'"', b'a"', b'"a"b', b'"a""', b"\\Nx", b"x\\N"]
    for _ in range(300):
        lines = [b"\t".join(draw.choice(values[: draw.choice((5, 13))]) for _ in range(3)) for _ in range(100)]
        told = tsv_records.simple(pa.array([b'"', *lines, b"\\"], pa.binary()).slice(1, 100))
        for ok, line in zip(told, lines):
            assert after(START, line) == START if ok else not set(line.split(b"\t")) <= set(values[:5])
        whole = [line for ok, line in zip(told, lines) if ok]
        found = tsv_records._columns(pa.array(whole, pa.binary()), 3)
        assert [list(r.values()) for r in found.to_pylist()] == [fields(line) for line in whole]


def test_stretches_of_simple_lines_are_not_walked(monkeypatch):
    lines = [b'%d\t"a"\t\\N' % i for i in range(1_000)]
    want = [[b"%d" % i, b"a", None] for i in range(1_000)]
    walked = []
    monkeypatch.setattr(tsv_records, "after", lambda state, line: walked.append(line) or after(state, line))
    told = [r for batch in tsv_records._outcomes([block_of(lines)]) for r in batch.to_pylist()]
    # Two lines at most until the ways meet, each under the ways that differ.
    assert len(walked) < 10 and [r["exit"] for r in told] == [START] * 3
    assert [r["head"] for r in told] == [None, lines[0], lines[0]] and not any(r["tail"] for r in told)
    walked.clear()
    cut = [list(r.values()) for batch in tsv_records._cut(3)([block_of(lines, pa.array([START] * 1_000))]) for r in batch.to_pylist()]
    assert not walked and cut == want
    # An open value, and its end, between two stretches; the rows stay in order.
    mixed = [*lines[:500], b'5\t"x', b'y"\t7', *lines[500:]]
    cut = [list(r.values()) for batch in tsv_records._cut(3)([block_of(mixed, pa.array([START] * 1_002))]) for r in batch.to_pylist()]
    assert cut == [*want[:500], [b"5", b"x\ny", b"7"], *want[500:]]
    with pytest.raises(MalformedRecordError, match="2 values for 3"):
        list(tsv_records._cut(3)([block_of([*lines, b"1\t2"] + lines, pa.array([START] * 2_001))]))


def test_marked_texts_are_written_by_as_many_tasks_as_read_them(spark, sf_dir, tmp_path, monkeypatch):
    from chunkspark.plans import exchange
    written = []
    monkeypatch.setattr(exchange, "export_tsv", lambda rows, path: written.append((rows.rdd.getNumPartitions(), export_tsv(rows, path))))
    monkeypatch.setattr(exchange, "read_table", lambda spark, sf, name: spark.read.parquet(f"{tmp_path}/{name}"))
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet")
    documents.repartition(6).write.parquet(f"{tmp_path}/documents")
    before = spark.conf.get("spark.sql.files.openCostInBytes")
    spark.conf.set("spark.sql.files.openCostInBytes", 1 << 30)
    try:
        found = exchange.tsv_null_mark(spark, sf_dir)
        assert written[0][0] == 6 and found.count() == documents.count()
    finally:
        spark.conf.set("spark.sql.files.openCostInBytes", before)

"""Archives, delimited text and fallbacks on files with awkward contents."""

import random
import zipfile

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from lamina.schemas import ENTITY_WORDS, raw_schema
from lamina.sinks import land_archives, land_entries
from lamina.sources.archives import packed
from lamina.sources import (
    classify_archives,
    detect_separators,
    entry_lines,
    expand_entries,
    is_readable,
    list_entries,
    list_files,
    read_delimited,
    read_detected,
    read_first_available,
    read_landing,
    read_manifest,
    resolve_archives,
)

EDGE = (
    '"00000001";"AÇÃO; LTDA";"2062";"49";"1000,50";"03";""\n'
    '"00000002";"B ""X"" ME";"2135";"50";"0,00";"01"\n'
    "00000003;;2135;50;;03;;EXTRA\n"
    '"4";"multi\nline";"1";"2";"3";"05";"z"\n'
).encode("iso-8859-1")


def write_zip(path, **entries):
    path.parent.mkdir(parents=True, exist_ok=True)
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for name, content in entries.items():
            z.writestr(name, content)


@pytest.fixture
def edge(tmp_path):
    path = tmp_path / "edge.csv"
    path.write_bytes(EDGE)
    return str(path)


def test_schemaless_scan_pads_and_cuts(spark, edge):
    got = read_delimited(spark, edge).collect()
    assert len(got) == 5 and got[0]["_c1"] == "AÇÃO; LTDA" and got[0]["_c6"] is None
    assert got[1]["_c1"] == 'B "X" ME' and got[1]["_c6"] is None
    assert got[2]["_c1"] is None and got[2]["_file"].endswith("edge.csv") and len(got[2]) == 8


def test_multi_line_records(spark, edge):
    got = read_delimited(spark, edge, multi_line=True).collect()
    assert len(got) == 4 and got[3]["_c1"] == "multi\nline"


def state_after(state, text):
    """The state of delimited text behind ``text``, byte by byte."""
    for c in text:
        if state in "NSU":
            state = "S" if c == ";" else "N" if c == "\n" else "Q" if c == '"' and state != "U" else "U"
        elif state == "Q":
            state = "E" if c == '"' else "Q"
        else:
            state = "Q" if c == '"' else "S" if c == ";" else "N" if c == "\n" else "U"
    return state


def test_states_of_ranges():
    from lamina.sources.records import STATES, scanner_maker

    draw = random.Random(3)
    ending, first = scanner_maker()(";")[:2]
    for _ in range(20_000):
        text = "".join(draw.choice('"";\nab') for _ in range(draw.randrange(14)))
        assert ending(text.encode()) == "".join(state_after(s, text) for s in STATES), text
        for s in STATES:
            begins = [i for i in range(len(text) + 1) if state_after(s, text[:i]) == "N"]
            assert (first(text.encode(), s) or 0) % (len(text) or 1) == (begins or [0])[0] % (len(text) or 1), (s, text)


@pytest.mark.parametrize("range_bytes", [7, 64, 1000, 1 << 20])
def test_records_do_not_depend_on_ranges(spark, tmp_path, rows, settings, range_bytes):
    """Line breaks in quotes, doubled and stray quotes, blank lines, records longer than a range and a last one without an end."""
    settings(lamina__shuffle__mostPartitions="4")
    draw = random.Random(5)
    fields = ["a", "", '""', '"x\n;y"', '"q""\n""q"', 'in"side', '"closed"more', " ", '"é\n\n"', '"' + "long\n" * 300 + '"']
    for name, sep in (("a.csv", ";"), ("b.csv", "|")):
        lines = [sep.join(draw.choice(fields).replace(";", sep) for _ in range(draw.randrange(1, 5))) for _ in range(60)]
        (tmp_path / name).write_bytes("\n".join([f"1{sep}2{sep}3{sep}4{sep}5", *lines]).encode("iso-8859-1"))
    (tmp_path / "empty.csv").write_bytes(b"")
    (tmp_path / "open.csv").write_bytes(b'1;"never closed\n2;3\n')
    got = read_detected(spark, str(tmp_path), multi_line=True, range_bytes=range_bytes)
    assert got.columns == ["_c0", "_c1", "_c2", "_c3", "_c4", "_file"]
    whole = [
        spark.read.options(sep=sep, quote='"', escape='"', multiLine="true", encoding="ISO-8859-1").schema(raw_schema(5)).csv(str(tmp_path / name))
        for name, sep in (("a.csv", ";"), ("b.csv", "|"))
    ]
    assert rows(got.filter(~F.col("_file").contains("open.csv")).drop("_file")) == rows(whole[0].unionByName(whole[1]))
    assert got.filter(F.col("_file").contains("open.csv")).count() == 1


def test_rows_of_the_wrong_width_are_flagged(spark, edge):
    df = read_delimited(spark, edge, schema=raw_schema(7), multi_line=True, corrupt="_bad")
    flagged = {r["_c0"]: r["_bad"] is not None for r in df.collect()}
    assert flagged == {"00000001": False, "00000002": True, "00000003": True, "4": False}
    with pytest.raises(ValueError):
        read_delimited(spark, edge, corrupt="_bad")


def test_a_path_given_twice_is_read_once(spark, edge):
    assert read_delimited(spark, [edge, edge]).count() == 5


def test_separator_per_file(spark, tmp_path, rows):
    (tmp_path / "a.csv").write_text("1|x;y\n2|z\n")
    (tmp_path / "b.CSV").write_text("3,w,extra\n")
    (tmp_path / "note.txt").write_text("4;5\n")
    found = detect_separators(list_files(spark, str(tmp_path), ".csv"))
    assert sorted(r["sep"] for r in found.collect()) == [",", "|"]
    assert rows(read_detected(spark, str(tmp_path)), "_c0", "_c1", "_c2") == sorted(
        [("1", "x;y", None), ("2", "z", None), ("3", "w", "extra")], key=repr
    )


def test_only_the_first_bytes_decide_the_separator(spark, tmp_path):
    (tmp_path / "a.csv").write_text("a;b\n" + "c" * 5000 + ",,,,,,,,\n")
    assert [r["sep"] for r in detect_separators(list_files(spark, str(tmp_path))).collect()] == [";"]


def test_listing(spark, tmp_path):
    write_zip(tmp_path / "raw" / "sub" / "X 1.ZIP", a="1")
    (tmp_path / "raw" / "b.txt").write_text("no")
    assert [r["name"] for r in list_files(spark, str(tmp_path / "raw"), ".zip").collect()] == ["X 1.ZIP"]
    assert list_files(spark, str(tmp_path / "absent")).count() == 0
    plan = list_files(spark, str(tmp_path / "raw"))._jdf.queryExecution().executedPlan().toString()
    assert "content" not in plan


def test_positional_fallback_needs_exactly_two_unknown_names(spark, tmp_path):
    def entities(*names):
        folder = tmp_path / "-".join(names)
        for n in names:
            write_zip(folder / n, a="1")
        out = classify_archives(list_files(spark, str(folder)), ENTITY_WORDS, tuple(ENTITY_WORDS))
        return {r["name"]: r["entity"] for r in out.collect()}

    assert entities("b.zip", "a.zip") == {"a.zip": "empresas", "b.zip": "socios"}
    assert entities("a.zip", "Empresas0.zip") == {"Empresas0.zip": "empresas"}
    assert entities("a.zip") == {} and entities("a.zip", "b.zip", "c.zip") == {}


def test_archive_roots_are_tried_in_order(spark, tmp_path):
    raw, spare = str(tmp_path / "raw"), str(tmp_path / "spare")
    write_zip(tmp_path / "spare" / "Socios.zip", a="1")
    write_zip(tmp_path / "raw" / "unknown.zip", a="1")
    found, origin = resolve_archives(spark, [raw, spare], ENTITY_WORDS)
    assert origin == spare and [r["entity"] for r in found.collect()] == ["socios"]
    found, origin = resolve_archives(spark, [raw, spare], ENTITY_WORDS, {"empresas": [f"{raw}/unknown.zip"]})
    assert origin == "explicit" and [r["entity"] for r in found.collect()] == ["empresas"]
    with pytest.raises(FileNotFoundError):
        resolve_archives(spark, [raw], ENTITY_WORDS)


def test_entries_of_equal_names_stay_apart(spark, tmp_path, rows):
    for i in (0, 1):
        write_zip(tmp_path / f"Empresas{i}.zip", **{"d/K.EMPRE.CSV": f"{i}a\n{i}b\r\n{i}c", "README.txt": "x", "d/": ""})
    entries = list_entries(list_files(spark, str(tmp_path), ".zip"))
    assert rows(entries, "entry", "size") == [("d/K.EMPRE.CSV", 9)] * 2
    lines = entry_lines(expand_entries(entries))
    assert rows(lines, "_archive", "value") == sorted(
        [(f"Empresas{i}.zip", f"{i}{c}") for i in (0, 1) for c in "abc"], key=repr
    )


@pytest.mark.parametrize("size", [1, 2, 7, 64, 1 << 20])
@pytest.mark.parametrize("content", [b"a\nbb\n\nccc\n", b"a\nbb\n\nccc", b"\n", b"", b"one line only", b"\n\nx"])
def test_blocks_hold_whole_lines(spark, tmp_path, size, content):
    """Whatever the block size, the lines are those of the entry."""
    write_zip(tmp_path / "E.zip", **{"k.csv": content})
    chunks = expand_entries(list_entries(list_files(spark, str(tmp_path), ".zip")), chunk_bytes=size)
    got = entry_lines(chunks).sort("chunk", "line").collect()
    assert [r["value"] for r in got] == content.decode().splitlines()


@pytest.mark.parametrize("ordered", [False, True])
def test_landing_is_byte_for_byte(spark, tmp_path, ordered):
    body = EDGE * 50
    write_zip(tmp_path / "raw" / "Sócios 1.zip", **{"d/K.CSV": body, "p.csv": "1|2\n3|4\n"})
    archives = list_files(spark, str(tmp_path / "raw"), ".zip")
    chunks = expand_entries(list_entries(archives), chunk_bytes=100)
    land_entries(chunks, str(tmp_path / "out" / "csv"), ordered)
    landed = [p for p in (tmp_path / "out" / "csv").rglob("part-*") if "semicolon" in str(p)]
    assert len(landed) == 1 and landed[0].read_bytes() == body
    table = read_landing(spark, str(tmp_path / "out" / "csv"), multi_line=True)
    assert table.count() == 4 * 50 + 2
    assert {r["_archive"] for r in table.select("_archive").distinct().collect()} == {"Sócios 1.zip"}
    assert table.columns[:3] == ["_c0", "_c1", "_c2"] and "_entry" in table.columns


def test_large_entries_are_landed_in_several_files(spark, tmp_path, monkeypatch):
    monkeypatch.setattr("lamina.sinks.landing.FILE_BLOCKS", 7)
    body = "".join(f"{i};x\n" for i in range(3000))
    write_zip(tmp_path / "raw" / "E.zip", **{"k.csv": body, "l.csv": body})
    entries = list_entries(list_files(spark, str(tmp_path / "raw"), ".zip"))
    land_entries(expand_entries(entries, chunk_bytes=1 << 10), str(tmp_path / "csv"))
    files = list((tmp_path / "csv").rglob("part-*"))
    assert len(files) > 4 and sum(f.stat().st_size for f in files) == 2 * len(body)
    got = read_landing(spark, str(tmp_path / "csv")).groupBy("_c0").count()
    assert got.count() == 3000 and got.filter("count <> 2").isEmpty()


def test_a_batch_replaces_only_itself(spark, tmp_path, rows):
    for name in ("a", "b"):
        write_zip(tmp_path / name / "E.zip", **{"k.csv": f"{name};1\n"})
    out = str(tmp_path / "out")
    for name, batch in (("a", 0), ("b", 1), ("b", 1), ("a", 0)):
        assert land_archives(list_files(spark, str(tmp_path / name), ".zip"), out, batch=batch) == 1
    assert rows(read_landing(spark, f"{out}/csv"), "_c0", "_batch") == [("a", 0), ("b", 1)]


def test_equal_archive_names_in_two_folders(spark, tmp_path):
    """Blocks of the two do not mix, even where one task inflates both."""
    for folder in "ab":
        body = "".join(f'{i};"{folder}\n{folder}"\n' for i in range(200))
        write_zip(tmp_path / "raw" / folder / "E.zip", **{"k.csv": body})
    entries = list_entries(list_files(spark, str(tmp_path / "raw"), ".zip"))
    land_entries(expand_entries(entries, chunk_bytes=10).coalesce(1), str(tmp_path / "csv"), ordered=True)
    got = read_landing(spark, str(tmp_path / "csv"), multi_line=True)
    assert sorted(r[0] for r in got.select("_c1").collect()) == ["a\na"] * 200 + ["b\nb"] * 200


def test_repeated_entry_names_are_all_read(spark, tmp_path, rows):
    (tmp_path / "raw" / "sub").mkdir(parents=True)
    for name in ("E.zip", "sub/E.zip"):
        with pytest.warns(UserWarning), zipfile.ZipFile(tmp_path / "raw" / name, "w") as z:
            z.writestr("k.csv", f"{name};1\n")
            z.writestr("k.csv", f"{name};2\n")
    archives = list_files(spark, str(tmp_path / "raw"), ".zip")
    expected = [(n, n, c) for n in ("E.zip", "sub/E.zip") for c in "12"]
    for ordered in (False, True):
        land_archives(archives, str(tmp_path / "out"), ordered=ordered)
        assert rows(read_landing(spark, str(tmp_path / "out" / "csv")), "_archive", "_c0", "_c1") == expected


def test_entries_are_packed_by_size(spark):
    """No two large entries share a task, and tasks grow with bytes, not with entries."""
    sizes = "CASE WHEN id % 100 = 0 THEN 1000 + id ELSE 1 END"
    entries = spark.range(2000).selectExpr("concat('p', id % 7) AS path", "CAST(id AS INT) AS nth", f"{sizes} AS size")
    dealt, tasks = packed(entries, 1000)
    loads = dealt.groupBy("_task").agg(F.sum("size").alias("size"), F.count("nth").alias("n")).collect()
    assert dealt.count() == 2000 and all(0 <= r["_task"] < tasks for r in loads)
    assert all(r["n"] == 1 or r["size"] < 2000 for r in loads)
    assert sum(r["size"] >= 1000 for r in loads) == 20 and tasks <= 20 + 64
    assert packed(entries.limit(0), 1000)[1] == 1


def test_what_landed_first_stays(spark, tmp_path, rows):
    out = str(tmp_path / "out")
    for turn, name, lines in ((0, "E", "a;1\n"), (1, "E", "b;1\n"), (1, "F", "c|2\n"), (2, "F", "d;3\n")):
        write_zip(tmp_path / f"raw{turn}" / f"{name}.zip", **{"k.csv": lines})
    landed = [land_archives(list_files(spark, str(tmp_path / f"raw{i}"), ".zip"), out, keep_landed=True) for i in range(3)]
    assert landed == [1, 1, 0]
    assert rows(read_landing(spark, f"{out}/csv"), "_c0", "_archive") == [("a", "E.zip"), ("c", "F.zip")]


def test_no_row_is_cut_by_the_width_of_another(spark, tmp_path, rows):
    (tmp_path / "ç 1+1%.csv").write_bytes('1;"a;""b"\n\n2;ç;d;e\n'.encode("iso-8859-1"))
    assert rows(read_detected(spark, str(tmp_path)).drop("_file")) == [("1", 'a;"b', None, None), ("2", "ç", "d", "e")]
    (tmp_path / "note.txt").write_text("9,9,9,9,9,9,9\n")
    assert read_detected(spark, str(tmp_path), schema=raw_schema(2), multi_line=True).count() == 2
    (tmp_path / "b.csv").write_text("3|w\n")
    got = read_detected(spark, str(tmp_path), schema=raw_schema(2), corrupt="_bad")
    assert rows(got.drop("_file")) == [("1", 'a;"b', None), ("2", "ç", "2;ç;d;e"), ("3", "w", None)]
    assert rows(read_detected(spark, str(tmp_path), multi_line=True).drop("_file")) == [
        ("1", 'a;"b', None, None),
        ("2", "ç", "d", "e"),
        ("3", "w", None, None),
    ]


def test_archives_without_entries_land_nothing(spark, tmp_path):
    write_zip(tmp_path / "raw" / "Empresas.zip", **{"K.EMPRECSV": "1;2\n"})
    archives = list_files(spark, str(tmp_path / "raw"), ".zip")
    assert land_archives(archives, str(tmp_path / "out")) == 0
    assert land_archives(archives, str(tmp_path / "out"), suffix="CSV") == 1
    assert read_landing(spark, str(tmp_path / "out" / "csv")).count() == 1


def test_archives_through_arrow_file_systems(spark, tmp_path, rows):
    """The way object stores are read, on a local file system."""
    write_zip(tmp_path / "E.zip", **{"k.csv": "".join(f"{i};x\n" for i in range(5000))})

    def opener(path):
        import io

        from pyarrow import fs

        return io.BufferedReader(fs.LocalFileSystem().open_input_file(path.removeprefix("file:")), 1 << 10)

    entries = list_entries(list_files(spark, str(tmp_path), ".zip"), opener=opener)
    lines = entry_lines(expand_entries(entries, chunk_bytes=1 << 12, opener=opener))
    assert lines.count() == 5000 and lines.select("value").distinct().count() == 5000


def test_a_broken_archive_is_an_error(spark, tmp_path):
    (tmp_path / "Empresas.zip").write_bytes(b"not a zip")
    with pytest.raises(Exception, match="not a zip file"):
        list_entries(list_files(spark, str(tmp_path), ".zip")).collect()


def test_fallback(spark, tmp_path, edge, rows):
    stored = str(tmp_path / "t")
    candidates = [("parquet", stored, {}), ("csv", edge, {"sep": ";"})]
    assert read_first_available(spark, candidates).columns[0] == "_c0"
    spark.range(0).write.parquet(stored)
    assert is_readable(spark, stored) and read_first_available(spark, candidates).columns == ["id"]
    with pytest.raises(FileNotFoundError):
        read_first_available(spark, [("parquet", str(tmp_path / "no"), {})])


def test_real_errors_are_not_taken_for_absence(spark, tmp_path):
    (tmp_path / "broken.parquet").write_bytes(b"PAR1 this is not parquet")
    with pytest.raises(Exception) as e:
        is_readable(spark, str(tmp_path / "broken.parquet"))
    assert not isinstance(e.value, AnalysisException) or "PATH_NOT_FOUND" not in str(e.value)


def test_manifest(spark, tmp_path, rows):
    (tmp_path / "urls.txt").write_text("https://h/a.zip\n\n  https://h/b.zip \n")
    assert rows(read_manifest(spark, str(tmp_path / "urls.txt"))) == [("https://h/a.zip",), ("https://h/b.zip",)]

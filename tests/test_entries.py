"""The streaming source of archive entries: bounded batches, late names, replays, odd archives."""

import json
import zipfile

import pytest
from pyspark.errors import StreamingQueryException

from lamina.sources import entry_lines
from lamina.streaming import drain_to_table, entry_stream


def put(path, **entries):
    path.parent.mkdir(parents=True, exist_ok=True)
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for name, content in entries.items():
            z.writestr(name, content)


@pytest.fixture
def run(spark, tmp_path):
    def drain(batch_bytes=3 * 4096, folder=None, **options):
        raw = folder or f"file://{tmp_path}/raw"
        blocks = entry_stream(spark, raw, f"{tmp_path}/plan", batch_bytes=batch_bytes, **options)
        drain_to_table(entry_lines(blocks), f"{tmp_path}/lines", f"{tmp_path}/checkpoint")
        lines = spark.read.schema("_archive string, _entry string, value string").parquet(f"{tmp_path}/lines")
        return sorted(tuple(r) for r in lines.select("_archive", "_entry", "value").collect())

    return drain


def steps(tmp_path):
    return [json.loads(p.read_text()) for p in sorted((tmp_path / "plan").glob("step-*.json"))]


def test_batches_are_bounded_and_an_archive_may_span_them(tmp_path, run):
    put(tmp_path / "raw" / "a.zip", **{f"{i}.csv": f"{i}x\n{i}y" for i in range(7)}, **{"d/": "", "t.txt": "no"})
    put(tmp_path / "raw" / "sub" / "b.ZIP", **{"K.CSV": "z\n" * 5000, "k.csv": ""})
    got = run()
    whole = [("a.zip", f"{i}.csv", f"{i}{c}") for i in range(7) for c in "xy"] + [("sub/b.ZIP", "K.CSV", "z")] * 5000
    assert [g for g in got if g[2]] == sorted(whole)
    sizes = [[e[4] for e in s["entries"]] for s in steps(tmp_path)]
    assert len(sizes) > 3 and all(sum(s) <= 3 * 4096 or len(s) == 1 for s in sizes)
    planned = [(e[0], e[3]) for s in steps(tmp_path) for e in s["entries"]]
    assert len(planned) == len(set(planned)) == 9


def test_what_arrives_later_is_added_once_whatever_its_name(tmp_path, run):
    put(tmp_path / "raw" / "m.zip", **{"k.csv": "1\n"})
    assert run() == run() == [("m.zip", "k.csv", "1")]
    put(tmp_path / "raw" / "a.zip", **{"k.csv": "0\n"})
    put(tmp_path / "raw" / "m.zip", **{"k.csv": "changed\n"})
    put(tmp_path / "raw" / "z.zip", **{"k.csv": "2\n", "none.txt": "x"})
    put(tmp_path / "raw" / "none.zip", **{"none.txt": "x"})
    want = [("a.zip", "k.csv", "0"), ("m.zip", "k.csv", "1"), ("z.zip", "k.csv", "2")]
    assert run() == run() == want


def test_a_step_that_was_planned_and_not_begun_is_read_after_a_restart(tmp_path, run):
    put(tmp_path / "raw" / "a.zip", **{f"{i}.csv": f"{i}\n" for i in range(3)})
    (tmp_path / "plan").mkdir()
    first = {"step": 1, "archives": ["a.zip"], "rest": ["a.zip", 1], "entries": [[f"{tmp_path}/raw/a.zip", "a.zip", "0.csv", 0, 4096]]}
    (tmp_path / "plan" / "step-0000000001.json").write_text(json.dumps(first))
    (tmp_path / "plan" / "step-0000000002.json.part").write_text("{")
    assert run(4096) == [("a.zip", f"{i}.csv", str(i)) for i in range(3)]
    assert [len(s["entries"]) for s in steps(tmp_path)] == [1, 1, 1]


def test_repeated_names_and_long_lines(tmp_path, run):
    path = tmp_path / "raw" / "twins.zip"
    path.parent.mkdir()
    with zipfile.ZipFile(path, "w") as z, pytest.warns(UserWarning):
        z.writestr("k.csv", "a" * 100 + "\nb")
        z.writestr("k.csv", "c")
    got = run(chunk_bytes=7, task_bytes=1)
    assert got == [("twins.zip", "k.csv", v) for v in ("a" * 100, "b", "c")]


def test_nothing_arrived(tmp_path, run):
    assert run() == [] and not (tmp_path / "plan").exists()


def test_a_replaced_or_broken_archive_stops_the_stream(tmp_path, run):
    put(tmp_path / "raw" / "a.zip", **{"0.csv": "0\n", "1.csv": "1\n"})
    (tmp_path / "plan").mkdir()
    first = {"step": 1, "archives": ["a.zip"], "rest": None, "entries": [[f"{tmp_path}/raw/a.zip", "a.zip", "1.csv", 0, 4096]]}
    (tmp_path / "plan" / "step-0000000001.json").write_text(json.dumps(first))
    with pytest.raises(StreamingQueryException, match="was replaced after it was planned"):
        run()
    (tmp_path / "raw" / "b.zip").write_bytes(b"PK half")
    with pytest.raises(StreamingQueryException):
        run()

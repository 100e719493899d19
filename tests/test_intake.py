"""Landed files: verdicts, routing, streaming intake."""

import gzip
import json
import os
import random
import re
import threading
import time
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from dimflow.functions.csvtext import header_names
from dimflow.functions.jsontext import is_one_json_value, is_parsed
from dimflow.functions.paths import decoded_key, decoded_uri
from dimflow.operators.verdicts import csv_rows, first_lines, row_starts
from dimflow.plans import landed as deliveries
from dimflow.sources.files import Files
from dimflow.sources.readers import landed_files, read_archive
from dimflow.streaming import intake
from dimflow.streaming.intake import judge_landed, take_in_new

DAY = "2025-05-20"


def land(root: Path, key: str, *lines: str, end: str = "\n") -> None:
    path = root / key
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text("".join(line + end for line in lines), encoding="utf-8")


@pytest.fixture
def landed(tmp_path):
    both = '{"event_id":"e1","customer_id":"c1"}'
    files = {
        "raw/customers/good.ndjson": ['{"customer_id":"c1","x":{"y":1}}', "", '{"customer_id":"c2"}'],
        "raw/customers/broken.ndjson": ['{"customer_id":"c1"}', '{"customer_id":'],
        "raw/customers/blank.ndjson": ["", "  ", "\t"],
        "raw/customers/empty.ndjson": [],
        "raw/customers/nokey.ndjson": ['{"id":"c1"}', '{"id":"c2"}'],
        "raw/customers/nullkey.ndjson": ['{"customer_id":null}'],
        "raw/customers/trailing.ndjson": ['{"customer_id":"c1"} {"customer_id":"c2"}'],
        "raw/activity_logs/spread.ndjson": ['{"event_id":"e"}', '{"customer_id":"c"}'],
        "raw/activity_logs/nothing.ndjson": ['{"a":1}'],
        "raw/activity_logs/array.ndjson": ["[1, 2]"],
        "raw/activity_logs/arraykeys.ndjson": ['["event_id", "customer_id"]'],
        "raw/activity_logs/number.ndjson": [both, "17"],
        "raw/activity_logs/with space+plus.ndjson": [both],
        "raw/plans/good.csv": ["plan_id,plan_name", 'P1,"a, b"', "P2,c"],
        "raw/plans/quoted.csv": ['"plan_name","plan_id"', "a,P1", "", "b,P2"],
        "raw/plans/onerow.csv": ["plan_id,plan_name", "P1,a"],
        "raw/plans/header.csv": ["plan_id,plan_name"],
        "raw/plans/nocolumn.csv": ["id,plan_name", "P1,a", "P2,b"],
        "raw/plans/empty.csv": [],
        "raw/other/what.txt": ["x"],
        "archive/customers/2025-01-01/old.ndjson": ['{"customer_id":"c9"}'],
    }
    for key, lines in files.items():
        land(tmp_path, key, *lines)
    return tmp_path


EXPECTED = {
    "customers/good.ndjson": "ok",
    "customers/broken.ndjson": "invalid_ndjson_format",
    "customers/blank.ndjson": "no_json_lines_detected",
    "customers/empty.ndjson": "no_json_lines_detected",
    "customers/nokey.ndjson": "missing_fields_['customer_id']",
    "customers/nullkey.ndjson": "ok",
    "customers/trailing.ndjson": "invalid_ndjson_format",
    "activity_logs/spread.ndjson": "ok",
    "activity_logs/nothing.ndjson": "missing_fields_['event_id', 'customer_id']",
    "activity_logs/array.ndjson": "missing_fields_['event_id', 'customer_id']",
    "activity_logs/arraykeys.ndjson": "ok",
    "activity_logs/number.ndjson": "invalid_ndjson_format",
    "activity_logs/with space+plus.ndjson": "ok",
    "plans/good.csv": "ok",
    "plans/quoted.csv": "ok",
    "plans/onerow.csv": "no_data_rows_found",
    "plans/header.csv": "no_data_rows_found",
    "plans/nocolumn.csv": "missing_columns_['plan_id']",
    "plans/empty.csv": "missing_columns_['plan_id']",
    "other/what.txt": "unknown_folder_structure",
}


def check_manifest(manifest):
    found = {r["key"]: r for r in manifest.collect()}
    assert {k[4:]: r["reason"] for k, r in found.items()} == EXPECTED
    assert all(r["ok"] == (r["reason"] == "ok") for r in found.values())
    assert found["raw/customers/good.ndjson"]["moved_to"] == f"archive/customers/{DAY}/good.ndjson"
    assert found["raw/other/what.txt"]["moved_to"] == f"rejected/_unknown/{DAY}/what.txt"


def test_verdicts(spark, landed):
    check_manifest(judge_landed(spark, str(landed), DAY))


def lines_of(path: Path) -> list[str]:
    return path.read_text(encoding="utf-8").splitlines()


def check_routed(spark, root, before):
    """Every file is where the manifest says, byte for byte, and no longer below raw/."""
    manifest = spark.read.parquet(f"{root}/manifest").collect()
    for r in manifest:
        assert (Path(root) / r.moved_to).read_bytes() == before[r.key]
    assert not [p for p in (Path(root) / "raw").rglob("*") if p.is_file() and p.suffix != ".crc"]
    customers = read_archive(spark, root, "customers")
    found = {(r["customer_id"], str(r["archive_date"])) for r in customers.collect()}
    assert found == {("c1", DAY), ("c2", DAY), (None, DAY), ("c9", "2025-01-01")}
    plans = read_archive(spark, root, "plans")  # of files whose headers differ
    assert {(r["plan_id"], r["plan_name"]) for r in plans.collect()} == {("P1", "a, b"), ("P2", "c"), ("P1", "a"), ("P2", "b")}
    messages = [json.loads(r["value"]) for r in spark.read.text(f"{root}/alerts").collect()]
    by_file = {m["file"]: m for m in messages}
    assert len(by_file) == sum(reason != "ok" for reason in EXPECTED.values())
    assert set(by_file["raw/other/what.txt"]) == {"file", "reason"}
    assert set(by_file["raw/plans/header.csv"]) == {"file", "reason", "moved_to"}


def contents(root: Path) -> dict[str, bytes]:
    return {str(p.relative_to(root)): p.read_bytes() for p in (root / "raw").rglob("*.*") if p.is_file()}


def test_intake_takes_each_delivery_once(spark, landed, tmp_path_factory):
    root, state = str(landed), str(tmp_path_factory.mktemp("state"))
    before = contents(landed)
    assert take_in_new(spark, root, state, DAY) == [f"{DAY}-000001"]
    check_manifest(spark.read.parquet(f"{root}/manifest"))
    check_routed(spark, root, before)
    assert take_in_new(spark, root, state, DAY) == []
    land(landed, "raw/customers/late.ndjson", '{"customer_id":"c3"}')
    assert take_in_new(spark, root, state, "2025-05-21") == ["2025-05-21-000001"]
    manifest = spark.read.parquet(f"{root}/manifest")
    assert manifest.count() == len(EXPECTED) + 1
    assert manifest.filter("key like '%late%'").first()["ok"]
    assert not list(Path(state).rglob("part-*"))  # nothing is kept


def test_a_key_delivered_again_is_taken_in_again(spark, rows, tmp_path):
    root, state = str(tmp_path), str(tmp_path / "state")
    land(tmp_path, "raw/customers/a.ndjson", '{"customer_id":"c1"}')
    take_in_new(spark, root, state, DAY)
    land(tmp_path, "raw/customers/a.ndjson", '{"customer_id":"c2"}')  # same path and length, and old
    month_ago = time.time() - 30 * 86400
    os.utime(tmp_path / "raw/customers/a.ndjson", (month_ago, month_ago))
    take_in_new(spark, root, state, DAY)
    assert lines_of(tmp_path / f"archive/customers/{DAY}/a.ndjson") == ['{"customer_id":"c2"}']
    land(tmp_path, "raw/customers/a.ndjson", "{")
    take_in_new(spark, root, state, DAY)
    land(tmp_path, "raw/customers/a.ndjson", '{"customer_id":"c1"}')
    take_in_new(spark, root, state, "2025-05-21")
    manifest = spark.read.parquet(f"{root}/manifest")
    assert rows(manifest, "reason", "moved_to") == sorted([
        ("ok", f"archive/customers/{DAY}/a.ndjson"), ("ok", f"archive/customers/{DAY}/a.ndjson"),
        ("invalid_ndjson_format", f"rejected/customers/{DAY}/a.ndjson"), ("ok", "archive/customers/2025-05-21/a.ndjson"),
    ], key=repr)
    assert sorted(r.customer_id for r in read_archive(spark, root, "customers").collect()) == ["c1", "c2"]


def test_files_of_one_name_have_places_of_their_own(spark, tmp_path):
    root, state = str(tmp_path), str(tmp_path / "state")
    for i, sub in enumerate(("a/", "b/")):
        land(tmp_path, f"raw/customers/{sub}x.ndjson", f'{{"customer_id":"c{i}"}}')
    take_in_new(spark, root, state, DAY)
    land(tmp_path, "raw/customers/x.ndjson", '{"customer_id":"c2"}')
    land(tmp_path, "raw/customers/a/x.ndjson", '{"customer_id":"c3"}')
    take_in_new(spark, root, state, DAY)
    for r in spark.read.parquet(f"{root}/manifest").collect():
        assert (tmp_path / r.moved_to).exists()
    assert sorted(r.customer_id for r in read_archive(spark, root, "customers").collect()) == ["c1", "c2", "c3"]


def test_an_unreadable_file_does_not_stop_the_batch(spark, tmp_path):
    root, state = str(tmp_path), str(tmp_path / "state")
    lines = "".join(json.dumps({"customer_id": f"c{i}", "x": os.urandom(20).hex()}) + "\n" for i in range(20_000))
    whole = gzip.compress(lines.encode())
    files = {"good.ndjson.gz": whole, "cut.ndjson.gz": whole[: len(whole) // 2], "plain.ndjson.gz": lines.encode(), "empty.ndjson.gz": b""}
    for name, data in files.items():
        land(tmp_path, f"raw/customers/{name}")
        (tmp_path / "raw/customers" / name).write_bytes(data)
    land(tmp_path, "raw/customers/good.ndjson", '{"customer_id":"c1"}', end="\r\n")
    land(tmp_path, "raw/customers/mark.ndjson", '\ufeff{"customer_id":"c1"}', end="")
    take_in_new(spark, root, state, DAY)
    manifest = {r.key.split("/")[-1]: r for r in spark.read.parquet(f"{root}/manifest").collect()}
    assert {k: r.reason for k, r in manifest.items()} == {
        "good.ndjson.gz": "ok", "cut.ndjson.gz": "error_reading_file_incomplete", "plain.ndjson.gz": "error_reading_file_no_line_read",
        "empty.ndjson.gz": "no_json_lines_detected", "good.ndjson": "ok", "mark.ndjson": "ok",
    }
    assert all((tmp_path / r.moved_to).exists() for r in manifest.values())
    assert read_archive(spark, root, "customers").count() == 20_002


@pytest.mark.parametrize("step", ["judge_batch", "move_batch", "half_moved"])
def test_a_batch_that_stopped_is_finished_with_its_own_day(spark, rows, landed, tmp_path_factory, monkeypatch, step):
    root, state = str(landed), str(tmp_path_factory.mktemp("state"))
    before = contents(landed)

    def stop(*_):
        raise RuntimeError("stopped")

    if step == "half_moved":
        moves, whole = [], intake.Files.move

        def some(self, source, target):
            if len(moves) > 5:
                stop()
            moves.append(source)
            whole(self, source, target)

        monkeypatch.setattr(intake.Files, "move", some)
    else:
        monkeypatch.setattr(intake, step, stop)
    with pytest.raises(RuntimeError):
        take_in_new(spark, root, state, DAY)
    monkeypatch.undo()
    assert take_in_new(spark, root, state, "2025-05-22") == [f"{DAY}-000001"]
    check_manifest(spark.read.parquet(f"{root}/manifest"))
    check_routed(spark, root, before)


def test_a_file_replaced_under_way_is_another_delivery(spark, tmp_path):
    root, state = str(tmp_path), str(tmp_path / "state")
    land(tmp_path, "raw/customers/a.ndjson", '{"customer_id":"c1"}')
    batch = intake.plan_batch(spark, root, state, DAY)
    intake.judge_batch(spark, root, state, batch)
    land(tmp_path, "raw/customers/a.ndjson", "broken, and not judged yet")
    intake.move_batch(spark, root, state, batch)
    assert (tmp_path / "raw/customers/a.ndjson").exists()
    take_in_new(spark, root, state, DAY)
    assert lines_of(tmp_path / f"rejected/customers/{DAY}/a.ndjson") == ["broken, and not judged yet"]


def test_the_stream_takes_in_what_lands(spark, tmp_path):
    root, state = str(tmp_path), str(tmp_path / "state")
    land(tmp_path, "raw/customers/a.ndjson", '{"customer_id":"c1"}')
    query = intake.intake_stream(spark, root, state, 1)
    try:
        for _ in range(120):
            if (tmp_path / "manifest").exists() and not (tmp_path / "raw/customers/a.ndjson").exists():
                break
            time.sleep(0.5)
    finally:
        query.stop()
    assert spark.read.parquet(f"{root}/manifest").count() == 1


def test_lengths_of_landed_files(spark, landed):
    found = {r.uri: r.length for r in landed_files(spark, str(landed)).collect()}
    for path in (landed / "raw").rglob("*.*"):
        key = str(path.relative_to(landed)).replace(" ", "%20")
        assert found[key] == path.stat().st_size


def test_sample_mode_sees_the_start_only(spark, tmp_path):
    good = '{"customer_id":"c"}'
    land(tmp_path, "raw/customers/late.ndjson", *[good] * 300, "broken")
    land(tmp_path, "raw/customers/early.ndjson", *[good] * 299, "broken")
    wide = json.dumps({"customer_id": "c", "pad": "x" * 400_000})
    land(tmp_path, "raw/customers/cut.ndjson", wide, wide)
    land(tmp_path, "raw/customers/blank.ndjson", *[""] * 300, "broken")
    sample = {r["key"]: r["reason"] for r in judge_landed(spark, str(tmp_path), DAY, "sample").collect()}
    full = {r["key"]: r["reason"] for r in judge_landed(spark, str(tmp_path), DAY).collect()}
    assert sample == {
        "raw/customers/late.ndjson": "ok",
        "raw/customers/early.ndjson": "invalid_ndjson_format",
        "raw/customers/cut.ndjson": "ok",
        "raw/customers/blank.ndjson": "no_json_lines_detected",
    }
    assert full["raw/customers/late.ndjson"] == "invalid_ndjson_format"
    assert full["raw/customers/cut.ndjson"] == "ok"


def test_first_lines_counts_bytes(spark):
    lines = spark.createDataFrame(
        [("f", (0, i), "x" * 9) for i in range(5)],
        "uri string, line_no struct<start:bigint,row:bigint>, value string",
    )
    assert first_lines(lines, 300, 30).count() == 3
    assert first_lines(lines, 300, 29).count() == 3  # the last line needs no line end
    assert first_lines(lines, 300, 28).count() == 2
    assert first_lines(lines, 2, 1000).count() == 2


def test_json_check_agrees_with_a_strict_parser(spark):
    lines = [
        '{"a":1}', "[]", "[1,[2]]", '"text"', "{}", "3", "{", "", "x", '{"a":1} x', '{"a":1}{"b":2}',
        '{"a":1}] x', '{"a":1}} x', '{"a":1},{"b":2}', '{"a":1},"b":2', '"a":1', '{"a":1}, 2',
        "'a'", '{"a":1,}', "[1] [2]", '{"a":"\\u00e9"}', "nul", "1,2", '1],"b":[2', '"a',
        "{'a':1}", '{"a":\'x\'}', '{"it\'s":"o\'k"}', '{"a":"tab\there"}', '{\t"a":\t1}', '{a:1}',
        json.dumps({"long": '"x\\' * 50_000}), '{"a":01}', '{"a":"b" "c"}', '{"a":[1,2}',
    ]
    frame = spark.createDataFrame([(line,) for line in lines], "v string")
    got = frame.select("v", is_one_json_value(F.col("v")), is_parsed(F.col("v"))).collect()
    for line, sound, parsed in got:
        try:
            value, expected = json.loads(line), True
        except ValueError:
            value, expected = None, False
        assert sound is expected, line[:80]
        assert parsed is (expected and isinstance(value, (dict, list, str))), line[:80]


def test_header_names(spark):
    cases = {
        "plan_id,name": ["plan_id", "name"],
        '"plan_id","a, b",c': ["plan_id", "a, b", "c"],
        '"say ""hi""",x': ['say "hi"', "x"],
        "": [""],
        "a,,b": ["a", "", "b"],
    }
    frame = spark.createDataFrame([(k,) for k in cases], "h string")
    got = {r[0]: r[1] for r in frame.select("h", header_names(F.col("h"))).collect()}
    assert got == cases


CSV_FILES = {
    "a": 'h1,h2\n1,"two\nlines"\n2,"x"',
    "b": 'h1,"h\n2"\n1,"a ""quoted\n\n\n"" b",c\n5" pipe,"x"\n"q"tail,"open\nclosed", "not open\n3,4',
    "c": 'h1\n"never closed\n1\n2\n3',
    "d": '"\n"\n""\n"""\n"\n1,2,"\n,"",",x\n3',
    "e": "h\n\n1\n\n2",
    "f": "",
}


@pytest.mark.parametrize("split", [1, 2, 3, 100])
def test_rows_of_quoted_cells_over_lines_and_splits(spark, split):
    """Rows begin where a strict reader begins them, wherever a file is split."""
    r = random.Random(3)
    texts = dict(CSV_FILES)
    for i in range(60):
        texts[f"r{i}"] = "".join(r.choice('ab,,""\n\n" ') for _ in range(r.randrange(60)))
    rows, expected = [], {}
    for name, text in texts.items():
        lines = text.split("\n")
        rows += [(f"raw/plans/{name}", (n // split * 10, n), line) for n, line in enumerate(lines)]
        state, begins = "start", []
        for line in lines:
            begins.append(state == "start")
            state = "inside" if state == "inside" else "start"
            for i, c in enumerate(line):
                if state == "start":
                    state = "inside" if c == '"' else "start" if c == "," else "cell"
                elif state == "cell":
                    state = "start" if c == "," else "cell"
                elif state == "inside":
                    state = "quote" if c == '"' else "inside"
                elif state == "quote":
                    state = "inside" if c == '"' else "start" if c == "," else "cell"
            state = "inside" if state == "inside" else "start"
        expected[f"raw/plans/{name}"] = [(n, b) for n, b in enumerate(begins)]
    frame = spark.createDataFrame(rows, "uri string, line_no struct<start:bigint,row:bigint>, value string").repartition(5)
    found = {}
    for x in row_starts(frame).orderBy("uri", "line_no").collect():
        found.setdefault(x.uri, []).append((x.line_no.row, x.begins))
    assert found == expected
    told = {x.uri[10:]: (x.rows, x.header) for x in csv_rows(frame).collect() if x.uri[10:] in CSV_FILES}
    assert told["a"] == (3, "h1,h2") and told["c"][0] == 2 and told["e"] == (3, "h") and told["f"][0] == 0
    if split == 100:
        assert told["b"][1] == 'h1,"h\n2"'


def test_keys_and_uris_decode(spark):
    frame = spark.createDataFrame([("a+b%20c%2Bd",), ("100%",)], "k string")
    got = frame.select(decoded_key(F.col("k")), decoded_uri(F.col("k"))).collect()
    assert [tuple(r) for r in got] == [("a b c+d", "a+b c+d"), ("100%", "100%")]


def test_lines_of_csv_files_are_dealt_once(spark):
    schema = "uri string, line_no struct<start:bigint,row:bigint>, value string"
    frame = spark.createDataFrame([("raw/plans/a.csv", (0, 0), "plan_id"), ("raw/plans/a.csv", (100, 0), "P1")], schema)
    plan = csv_rows(frame)._jdf.queryExecution().executedPlan().toString()
    # A window over a field of the struct deals by a column of its own, `_w0`, and the next one deals again.
    assert "hashpartitioning(uri" in plan and not re.search(r"hashpartitioning\([^)]*_w\d", plan)


def test_deliveries_are_moved_many_at_once(spark, tmp_path, monkeypatch):
    alone = []
    plain = Files.move
    monkeypatch.setattr(Files, "move", lambda self, *names: (alone.append(threading.current_thread() is threading.main_thread()), plain(self, *names)))
    lines = spark.createDataFrame(
        [("plans", f"{n}.csv", 1, i, f"P{i}") for n in range(3) for i in range(2)],
        "folder string, file string, doc_id bigint, line_no int, value string",
    )
    deliveries.land(spark, lines, str(tmp_path), 2)
    found = sorted((tmp_path / "raw" / "plans").glob("*.csv"))
    assert [(f.name, f.read_text(), int(f.stat().st_mtime * 1000)) for f in found] == [
        (f"{n}.csv", "P0\nP1\n", deliveries.OLD) for n in range(3)
    ]
    assert alone == [False] * 3


def test_a_move_makes_few_calls(spark, tmp_path, monkeypatch):
    """A folder is made once, and a class is looked up once, however many files are moved."""
    from dimflow.sources.files import Files

    (tmp_path / "a").mkdir()
    for i in range(60):
        (tmp_path / "a" / str(i)).write_text(str(i))
    (tmp_path / "b").mkdir()
    (tmp_path / "b" / "3").write_text("old")
    client, sent = spark.sparkContext._gateway._gateway_client, []
    send = client.send_command
    monkeypatch.setattr(client, "send_command", lambda command, *a, **k: (sent.append(command), send(command, *a, **k))[1])
    files = Files(spark, str(tmp_path))
    files.move_all((f"a/{i}", f"b/{i}") for i in range(60))
    files.move("a/3", "b/3")  # moved before
    assert sorted((tmp_path / "b" / str(i)).read_text() for i in range(60)) == sorted(map(str, range(60)))
    # Two paths, two looks, the move, and now and then what is let go; each class name takes five more.
    assert len(sent) < 60 * 9 + 40

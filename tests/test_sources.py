import json
import os

import pytest

from corpusloom.sources import files
from corpusloom.streaming.incremental import build_instructions_incrementally, stream_nul_chunks


def test_text_lines_two_files(spark, tmpdir_path):
    with open(os.path.join(tmpdir_path, "a.txt"), "wb") as f:
        f.write(b"first\r\n\r\nthird\n")
    with open(os.path.join(tmpdir_path, "b.txt"), "wb") as f:
        f.write(b"x\ny")
    with open(os.path.join(tmpdir_path, "skip.md"), "wb") as f:
        f.write(b"ignored\n")
    got = sorted((r.file, r.idx, r.text) for r in files.read_text_lines(spark, tmpdir_path).collect())
    assert got == [("a.txt", 0, "first"), ("a.txt", 1, ""), ("a.txt", 2, "third"), ("b.txt", 0, "x"), ("b.txt", 1, "y")]


def test_instruction_layouts(spark, tmpdir_path):
    recs = [{"instruction": "i1", "input": "", "output": "o1"}, {"instruction": "i2", "input": None, "output": "o2"}]
    arr, lines = os.path.join(tmpdir_path, "arr"), os.path.join(tmpdir_path, "lines")
    os.makedirs(arr)
    os.makedirs(lines)
    with open(os.path.join(arr, "d.json"), "w") as f:
        json.dump(recs, f, indent=1)
    with open(os.path.join(lines, "d.json"), "w") as f:
        f.write("\n".join(json.dumps(r) for r in recs))
    ev = files.read_instructions(spark, lines, "lines", split="eval")
    assert {r.split for r in ev.collect()} == {"eval"}
    for path, layout in ((arr, "array"), (lines, "lines")):
        got = [(r.instruction, r.input, r.output) for r in files.read_instructions(spark, path, layout).collect()]
        assert sorted(got, key=str) == sorted([("i1", "", "o1"), ("i2", None, "o2")], key=str)


def test_dialogue_json_and_images(spark, tmpdir_path):
    data = [{"id": "1", "image": "img/a.jpg", "conversations": [{"from": "human", "value": "<image>\nq"},
                                                                 {"from": "gpt", "value": "a"}]},
            {"id": "2", "conversations": [{"from": "human", "value": "q"}]},
            {"id": "3", "image": "img/missing.jpg", "conversations": [{"from": "human", "value": "q"}]}]
    p = os.path.join(tmpdir_path, "dlg")
    os.makedirs(p)
    with open(os.path.join(p, "d.json"), "w") as f:
        json.dump(data, f)
    img = os.path.join(tmpdir_path, "imgs", "img")
    os.makedirs(img)
    with open(os.path.join(img, "a.jpg"), "wb") as f:
        f.write(b"\xff\xd8fake")
    d = files.read_dialogues(spark, p)
    assert files.dialogue_turns(d).count() == 4
    matched, missing = files.join_images(d.select("id", "image"), files.image_manifest(spark, os.path.join(tmpdir_path, "imgs")))
    assert sorted(r.id for r in matched.collect()) == ["1", "2"]
    assert [r.id for r in missing.collect()] == ["3"]


def test_nul_chunks_and_union_guard(spark, tmpdir_path):
    p = os.path.join(tmpdir_path, "nul")
    os.makedirs(p)
    with open(os.path.join(p, "s.bin"), "wb") as f:
        f.write(b'{"text": ["a", "b"]}\x00\x00{"text": ["c"]}\x00')
    assert sorted(r.text for r in files.read_nul_chunks(spark, p).collect()) == ["a", "b", "c"]
    a = spark.createDataFrame([(1, "x")], "id long, t string")
    b = spark.createDataFrame([(1, 2)], "id long, t long")
    with pytest.raises(ValueError):
        files.union_sources([a, b])
    assert files.union_sources([a, a]).count() == 2  # UNION ALL keeps duplicates


def test_cache_plan_manifest(spark, tmpdir_path):
    data, man = os.path.join(tmpdir_path, "in"), os.path.join(tmpdir_path, "manifest")
    os.makedirs(data)
    for n in ("a.txt", "b.txt"):
        with open(os.path.join(data, n), "w") as f:
            f.write(n)
    first = files.files_to_build(spark, data, man, "cfg1")
    assert first.count() == 2
    files.append_manifest(first, man)
    assert files.files_to_build(spark, data, man, "cfg1").count() == 0
    assert files.files_to_build(spark, data, man, "cfg2").count() == 2  # config change rebuilds
    with open(os.path.join(data, "c.txt"), "w") as f:
        f.write("new")
    assert [os.path.basename(r.file) for r in files.files_to_build(spark, data, man, "cfg1").collect()] == ["c.txt"]


def test_incremental_stream_build(spark, tmpdir_path):
    src, out, ck = (os.path.join(tmpdir_path, x) for x in ("src", "out", "ck"))
    os.makedirs(src)
    with open(os.path.join(src, "a.json"), "w") as f:
        f.write(json.dumps({"instruction": "i", "input": None, "output": "o"}) + "\n")
    build_instructions_incrementally(spark, src, out, ck)
    assert spark.read.parquet(out).count() == 1
    with open(os.path.join(src, "b.json"), "w") as f:
        f.write(json.dumps({"instruction": "j", "input": "x", "output": "p"}) + "\n")
        f.write(json.dumps({"instruction": "k", "input": "x", "output": None}) + "\n")
    build_instructions_incrementally(spark, src, out, ck)
    rows = spark.read.parquet(out).collect()
    assert len(rows) == 2  # a.json not reprocessed; null output rejected
    assert sorted(r.file for r in rows) == ["a.json", "b.json"]


def test_nul_chunk_stream(spark, tmpdir_path):
    p = os.path.join(tmpdir_path, "nuls")
    os.makedirs(p)
    with open(os.path.join(p, "s.bin"), "wb") as f:
        f.write(b'{"text": ["a"]}\x00{"text": ["b", "c"]}\x00')
    q = stream_nul_chunks(spark, p).writeStream.format("memory").queryName("nul_out").start()
    q.processAllAvailable()
    q.stop()
    assert sorted(r.text for r in spark.sql("select * from nul_out").collect()) == ["a", "b", "c"]


def _small_splits(spark, n):
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(n))
    spark.conf.set("spark.sql.files.openCostInBytes", "1")


@pytest.fixture()
def splits(spark):
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    yield lambda n: _small_splits(spark, n)
    for k, v in old.items():
        spark.conf.set(k, v)


ODD_RECORDS = [
    {"id": "1", "conversations": [{"from": "human", "value": 'a "quoted" {brace} \\'}, {"from": "gpt", "value": "}{][ \\\" }"}]},
    {"id": "2", "conversations": []},
    {},
    {"id": "}", "image": "[{", "conversations": [{"from": "human", "value": "long " * 200}]},
    {"id": "é中🙂", "conversations": [{"from": "\\", "value": "\n\t\u0007}"}, {"from": "}", "value": '"}"'}]},
    {"id": "6", "more": {"deep": [[{"x": [1, 2, {"y": {}}]}], "}"]}, "conversations": [{"from": "gpt", "value": None}]},
]


@pytest.mark.parametrize("size, indent", [(67, None), (300, 2), (1 << 27, 1)])
def test_json_arrays_are_read_in_splits(spark, tmpdir_path, splits, size, indent):
    import random

    rng = random.Random(size)
    many = [rng.choice(ODD_RECORDS) | {"id": str(i)} for i in range(20)]
    p = os.path.join(tmpdir_path, "arr")
    os.makedirs(p)
    for name, data in (("a.json", ODD_RECORDS), ("b.json", many), ("c.json", []), ("d.json", [{}])):
        with open(os.path.join(p, name), "w") as f:
            json.dump(data, f, indent=indent, ensure_ascii=name == "a.json")
    open(os.path.join(p, "empty.json"), "w").close()
    splits(size)
    from corpusloom.sources.json_scan import read_json_array

    by = {}
    for r in sorted(read_json_array(spark, p).collect(), key=lambda r: (r.path, r.split, r.n)):
        by.setdefault(r.path.rpartition("/")[2], []).append(json.loads(r.json))
    assert by == {"a.json": ODD_RECORDS, "b.json": many, "d.json": [{}]}
    if size > 1000:
        got = files.read_dialogues(spark, p).collect()
        whole = spark.read.schema(files.DIALOGUE_SCHEMA).option("multiLine", "true").json(p).collect()
        assert sorted(map(str, got)) == sorted(str(r) for r in whole)


@pytest.mark.parametrize("text", ['[{"a": 1}', '[{"a": "}]', '{"a": 1}', '[{"a": {}]'])
def test_json_arrays_that_do_not_end_raise(spark, tmpdir_path, text):
    with open(os.path.join(tmpdir_path, "x.json"), "w") as f:
        f.write(text)
    with pytest.raises(ValueError, match="no whole JSON array"):
        files.read_dialogues(spark, tmpdir_path)


def test_text_lines_are_numbered_without_moving_them(spark, tmpdir_path, splits):
    want = []
    for name, n in (("a.txt", 500), ("b.txt", 1), ("c.txt", 300)):
        lines = [f"{name} line {i} " + "x" * (i % 40) for i in range(n)]
        want += [(name, i, t) for i, t in enumerate(lines)]
        with open(os.path.join(tmpdir_path, name), "w") as f:
            f.write("\n".join(lines))
    splits(300)
    out = files.read_text_lines(spark, tmpdir_path)
    assert sorted((r.file, r.idx, r.text) for r in out.collect()) == want
    # below every exchange lies the table of splits, not the files
    plan = out._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[-1].splitlines()
    at = [len(line) - len(line.lstrip(" :+-")) for line in plan]
    for i, line in enumerate(plan):
        if "Exchange " in line:
            below = next((j for j in range(i + 1, len(plan)) if at[j] <= at[i]), len(plan))
            assert not any("FileScan" in x for x in plan[i:below])
    assert any("FileScan" in x for x in plan)
    assert out.rdd.getNumPartitions() > 20

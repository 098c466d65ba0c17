import json
import os

import pytest

from corpusloom import constants as K
from corpusloom import programs


def test_pretraining_corpus_per_file_and_manifest(spark, tmpdir_path):
    src, out, man = (os.path.join(tmpdir_path, x) for x in ("txt", "out", "manifest"))
    os.makedirs(src)
    with open(os.path.join(src, "a.txt"), "w") as f:
        f.write("abc\n\ndefgh\n")
    with open(os.path.join(src, "b.txt"), "w") as f:
        f.write("xy\n")
    counts = {r.metric: r.value for r in programs.build_pretraining_corpus(
        spark, src, out, block_size=4, batch_rows=2, test_size=0.0, manifest_path=man).collect()}
    rows = spark.read.parquet(out).orderBy("file", "batch_id", "block_no").collect()
    # a.txt: batch 0 = [1,abc] + [1] -> 5 tokens -> one block of 4; batch 1 = [1,defgh] -> 6 -> one block
    # b.txt: [1,xy] -> 3 tokens < 4 -> its only (short) block is kept
    got = [(r.file, r.batch_id, list(r.input_ids)) for r in rows]
    a = [1] + [c + 3 for c in b"abc"] + [1]
    assert got[0] == ("a.txt", 0, a[:4])
    assert got[1] == ("a.txt", 1, ([1] + [c + 3 for c in b"defgh"])[:4])
    assert got[2] == ("b.txt", 0, [1] + [c + 3 for c in b"xy"])
    assert counts["train_samples"] == 3
    # second run: nothing new to build
    again = programs.build_pretraining_corpus(spark, src, out, block_size=4, batch_rows=2, manifest_path=man)
    assert again.count() == 0
    assert spark.read.parquet(out).count() == 3


def test_instruction_dataset_and_batches(spark, tmpdir_path):
    src, out = os.path.join(tmpdir_path, "sft"), os.path.join(tmpdir_path, "sft_out")
    os.makedirs(src)
    with open(os.path.join(src, "d.json"), "w") as f:
        json.dump([{"instruction": "i1", "input": "", "output": "o1"},
                   {"instruction": "i2", "input": "ctx", "output": "longer output"},
                   {"instruction": "i3", "input": None, "output": None}], f)
    ds = programs.build_instruction_dataset(spark, src, out, layout="array")
    assert ds.count() == 2
    b = programs.collate_instruction_batches(ds, batch_size=2).collect()
    assert len(b) == 2 and len({len(r.input_ids) for r in b}) == 1
    assert all(r.labels[-1] in (K.EOS_ID, K.IGNORE_INDEX) for r in b)


def test_dialogue_dataset(spark, tmpdir_path):
    src, out, img = (os.path.join(tmpdir_path, x) for x in ("dlg", "dlg_out", "imgs"))
    os.makedirs(src)
    os.makedirs(img)
    with open(os.path.join(img, "a.jpg"), "wb") as f:
        f.write(b"jpg")
    data = [{"id": "1", "image": "a.jpg", "conversations": [{"from": "human", "value": "what <image>"},
                                                             {"from": "gpt", "value": "a cat"}]},
            {"id": "2", "conversations": [{"from": "gpt", "value": "hello"}, {"from": "human", "value": "q"},
                                          {"from": "gpt", "value": "ans"}]},
            {"id": "3", "image": "gone.jpg", "conversations": [{"from": "human", "value": "q"}]}]
    with open(os.path.join(src, "d.json"), "w") as f:
        json.dump(data, f)
    ds, missing = programs.build_dialogue_dataset(spark, src, out, "meta-llama/Llama-2-7b-hf", image_folder=img,
                                                  batch_size=1, world_size=1)
    rows = {r.conv_id: r for r in ds.collect()}
    assert sorted(rows) == ["1", "2"] and [r.conv_id for r in missing.collect()] == ["3"]
    assert K.IMAGE_TOKEN_ID in rows["1"].input_ids and rows["1"].status == "ok"
    assert rows["2"].status == "ok" and rows["2"].n_supervised == len("ans ".encode()) + 1


def _write(path, text):
    with open(path, "w") as f:
        f.write(text)


def test_rebuilt_file_replaces_its_blocks(spark, tmpdir_path):
    src, out, man = (os.path.join(tmpdir_path, x) for x in ("txt", "out", "manifest"))
    os.makedirs(src)
    _write(os.path.join(src, "a.txt"), "first\n")
    _write(os.path.join(src, "b.txt"), "other\n")
    build = lambda: programs.build_pretraining_corpus(spark, src, out, block_size=64, test_size=0.0, manifest_path=man)
    build()
    _write(os.path.join(src, "a.txt"), "second text\n")
    os.utime(os.path.join(src, "a.txt"), (2_000_000_000, 2_000_000_000))
    build()
    texts = {r.file: bytes(i - 3 for i in r.input_ids[1:]).decode() for r in spark.read.parquet(out).collect()}
    assert texts == {"a.txt": "second text", "b.txt": "other"} and spark.read.parquet(out).count() == 2
    assert spark.read.parquet(man).count() == 2
    assert build().count() == 0  # both recorded


def test_files_of_one_name_stay_apart(spark, tmpdir_path):
    from corpusloom.sources import files

    for folder, text in (("x", "one\ntwo\n"), ("y", "three\n")):
        os.makedirs(os.path.join(tmpdir_path, folder))
        _write(os.path.join(tmpdir_path, folder, "same.txt"), text)
    got = files.read_text_lines(spark, [os.path.join(tmpdir_path, f) for f in ("x", "y")]).collect()
    assert sorted((r.file, r.idx, r.text) for r in got) == [("same.txt", 0, "one"), ("same.txt", 0, "three"), ("same.txt", 1, "two")]


def test_unreadable_manifest_is_no_first_build(spark, tmpdir_path):
    from corpusloom.sources import files

    src, man = os.path.join(tmpdir_path, "txt"), os.path.join(tmpdir_path, "manifest")
    os.makedirs(src)
    os.makedirs(man)
    _write(os.path.join(src, "a.txt"), "x\n")
    _write(os.path.join(man, "part-0.parquet"), "no parquet")
    with pytest.raises(Exception):
        files.files_to_build(spark, src, man, "v1").count()


def _dialogues(spark, tmpdir_path, records, **how):
    src, out = os.path.join(tmpdir_path, "dlg"), os.path.join(tmpdir_path, "out")
    os.makedirs(src, exist_ok=True)
    lines = how.get("layout") == "lines"
    _write(os.path.join(src, "d.json"), "\n".join(map(json.dumps, records)) if lines else json.dumps(records))
    return programs.build_dialogue_dataset(spark, src, out, "llama-2", batch_size=2, **how)[0]


def _talk(*texts, **more):
    return {"conversations": [{"from": "human" if i % 2 == 0 else "gpt", "value": t} for i, t in enumerate(texts)], **more}


@pytest.mark.parametrize("layout", ["array", "lines"])
def test_dialogues_without_ids_are_kept(spark, tmpdir_path, layout):
    rows = _dialogues(spark, tmpdir_path, [_talk("q1", "a1"), _talk("q2", "a2", id="7"), _talk("q3", "a3")], layout=layout).collect()
    assert len(rows) == 3 and len({r.conv_id for r in rows}) == 3 and "7" in {r.conv_id for r in rows}
    assert all(r.status == "ok" for r in rows)


def test_dialogues_of_one_id_raise(spark, tmpdir_path):
    with pytest.raises(ValueError, match="several records have the id '7'"):
        _dialogues(spark, tmpdir_path, [_talk("q1", "a1", id="7"), _talk("q2", "a2", id="7")])


def test_bad_dialogues_go_to_the_rejects(spark, tmpdir_path):
    twice = {"id": "twice", "conversations": [{"from": "human", "value": "q"}, {"from": "human", "value": "q"}]}
    bad = os.path.join(tmpdir_path, "bad")
    rows = _dialogues(spark, tmpdir_path, [_talk("q", "a", id="good"), twice, _talk("", "a", id="empty"), _talk(" \u3000", "\xa0", id="blank")],
                      rejects_dir=bad).collect()
    assert [r.conv_id for r in rows] == ["good"]
    assert {(r.conv_id, r.reason) for r in spark.read.parquet(bad).collect()} == {
        ("twice", "role_order"), ("empty", "empty_first"), ("blank", "no_words")}


def test_system_turns_keep_their_order(spark):
    from corpusloom.operators import dialogue, turns

    said = spark.createDataFrame([(1, 0, "system", "zzz"), (1, 1, "system", "aaa"), (1, 2, "user", "q"), (2, 0, "user", "q")],
                                 "conv_id long, turn long, role string, text string")
    want = {1: "zzz\naaa", 2: None}
    assert {r.conv_id: r.system for r in dialogue.records_from_turns(said).collect()} == want
    convs = turns.conversation_messages(said, lambda k: k < 0)[1]
    assert {r.conv_id: r.system for r in convs.collect()} == want


def test_wide_spaces_are_white_space(spark):
    from corpusloom.functions.text import py_strip, text_lines, word_count

    odd = ["\u3000你好\u3000世界\xa0x", "\x1ca\x85b\u2028", "", " \u205f", "a\rb\r\nc\n", "x\n\n"]
    rows = spark.createDataFrame([(t,) for t in odd], "t string").select("t", py_strip("t").alias("s"), word_count("t").alias("n"),
                                                                        text_lines("t").alias("lines")).collect()
    assert [(r.s, r.n) for r in rows] == [(t.strip(), len(t.split())) for t in odd]
    assert rows[4].lines == ["a", "b", "c"] and rows[5].lines == ["x", ""]

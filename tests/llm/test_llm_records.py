"""Personal data, the prefix trie and the Merkle manifest against brute force, named cases and edge cases."""

import hashlib
import random
import re
import time
import zlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from corpusloom.llm import merkle, pii, prefix_trie


def sha(s):
    return hashlib.sha256(s.encode() if isinstance(s, str) else s).hexdigest()


# --- personal data ---------------------------------------------------------------------------------------------------

PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(ds):
    return sum(sum(divmod(d * (1 + i % 2), 10)) for i, d in enumerate(reversed(ds))) % 10 == 0


def plain_spans(text):
    ok = {
        "email": lambda m: True,
        "ip": lambda m: all(int(p) <= 255 for p in m.split(".")),
        "card": lambda m: 13 <= len(ds := [int(c) for c in m if c.isdigit()]) <= 19 and luhn(ds),
        "phone": lambda m: 9 <= sum(c.isdigit() for c in m) <= 15,
    }
    return {k: [m.span() for m in re.finditer(p, text, re.A) if ok[k](m.group())] for k, p in PLAIN.items()}


PIECES = ["a", "b.c", "@", "@h.de", ".", "-", " ", "+", "+49", "(0)", "4", "041894974608795", "255", "256", "1.2", "..", "%", "é", "\n",
          "4111 1111 1111 1111", "10.0.0.1", "007", "at", " dot ", "x@y.z"]


@settings(max_examples=400, deadline=None)
@given(st.lists(st.sampled_from(PIECES), max_size=14))
def test_base_spans_are_the_patterns_leftmost_matches(pieces):
    text = "".join(pieces)
    assert pii.detect(text) == plain_spans(text)
    base, added = pii.find(text)
    assert base == plain_spans(text)
    for kind in pii.KINDS:
        for a, b in added[kind]:
            assert 0 <= a < b <= len(text) and not any(x <= a and b <= y for x, y in base[kind])


DISGUISED = [
    ("email", "bosbt.42 at mail8 dot example dot com"),
    ("email", "bosbt.42 [at] mail8 [dot] example [dot] com"),
    ("email", "bosbt(at)mail8.example.com"),
    ("email", "bosbt dot 42 AT mail8 DOT example DOT com"),
    ("email", "bosbt.42 @ mail8 . example . com"),
    ("email", "john_dot_smith_at_mail_dot_com"),
    ("email", "um.x arroba mail punto es"),
    ("email", "bоsbt.42@mail8.exаmple.com"),
    ("email", "bos​bt.42@mail8.example.com"),
    ("email", "ｂｏsbt.42＠mail8．example．com"),
    ("ip", "42 dot 144 dot 35 dot 254"),
    ("ip", "42[.]144[.]35[.]254"),
    ("ip", "1.2.3 dot 4"),
    ("ip", "four two dot one four four dot three five dot two five four"),
    ("ip", "٤٢.144.35.254"),
    ("card", "four zero four one eight nine four nine seven four six zero eight seven nine five"),
    ("card", "vier null vier eins acht neun vier neun sieben vier sechs null acht sieben neun fünf"),
    ("card", "４０４１894974608795"),
    ("card", "4O4l894974608795"),
    ("card", "4041 8949 7460 87 nine 5"),
    ("phone", "plus three three six one two three four five six seven eight"),
    ("phone", "+33 6 12 34 5６ 78"),
    ("phone", "+33 6 double four 34 56 78"),
]


@pytest.mark.parametrize("kind, text", DISGUISED)
def test_disguises_are_found_where_they_stand(kind, text):
    before, after = "Né 🙂: write, ", ", s'il vous plaît."
    base, added = pii.find(before + text + after)
    assert added[kind] == [(len(before), len(before) + len(text))]
    for other in pii.KINDS:
        assert other == kind or not added[other]


@pytest.mark.parametrize("text", [
    "look at the dot product", "seen at example.com", "one 4041894974608795 two", "meet at noon. dot the i", "a point at this point in time",
    "pick one, two or three of the five", "2 plus 123456789 is", "Ёлка и ёж", "mail (at) home", "", "email@",
])
def test_plain_prose_gains_nothing(text):
    assert not any(pii.find(text)[1].values())


def test_personal_data_on_edge_cases(spark):
    texts = ["x@y.de", None, "", "x@y.de", "x at y dot de"]
    rows = [(i if i else None, t, "n", 1, "s") for i, t in enumerate(texts)] + [(3, "x@y.de", "n", 1, "s")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, base string, kind int, spans string")
    got = [(r.doc_id, [tuple(s) for s in r.base], [tuple(s) for s in r.spans]) for r in pii.personal_data(docs).collect()]
    one = [("email", 0, 6)]
    assert sorted(got, key=str) == sorted([(None, one, one), (1, [], []), (2, [], []), (3, one, one), (3, one, one),
                                           (4, [], [("email", 0, 13)])], key=str)
    assert pii.personal_data(docs.limit(0)).collect() == []
    assert {r.masked for r in pii.masked(docs).collect()} == {"[email]", ""}


def test_personal_data_on_long_texts_is_linear():
    begin = time.time()
    for t in ("a" * 300_000, "1" * 300_000, "1." * 150_000, "+1" * 150_000, " " * 300_000, "_at_x" * 60_000, "x-at-" * 60_000,
              "at at " * 50_000, " dot x" * 50_000, "a@" * 150_000, "one " * 60_000, "a at b.com " * 30_000, "[at]" * 60_000):
        pii.find(t)
    assert time.time() - begin < 60
    at = 1 << 20
    assert pii.find("é" * at + " x at y dot de")[1]["email"] == [(at + 1, at + 14)]


def test_op11_digests(spark, tmp_path):
    docs = spark.createDataFrame([(7, "a@b.c 10.0.0.1 x [at] y.de"), (8, None)], "doc_id long, text string")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    got = {r.doc_id: r for r in pii.op11_pii(spark, str(tmp_path)).collect()}
    assert (got[7].n_email, got[7].n_ip, got[7].n_card, got[7].n_phone) == (1, 1, 0, 0)
    assert got[7].base_sha256 == sha("email:0:5,ip:6:14") and got[7].spans == "email:0:5,email:15:26,ip:6:14"
    assert got[8].base_sha256 == sha("") and got[8].spans == ""


# --- prefix trie -----------------------------------------------------------------------------------------------------


def brute_trie(paths):
    """paths: conversation -> tuple of (role, text)."""
    nodes = {}
    for c, p in paths.items():
        for d in range(len(p) + 1):
            nodes.setdefault(p[:d], []).append(c)
    out = []
    for p, members in nodes.items():
        sub = [q for q in nodes if q[: len(p)] == p]
        leaves = [q for q in sub if not any(r[:-1] == q and len(r) == len(q) + 1 for r in nodes)]
        saved = sum((len(nodes[q]) - 1) * len(q[-1][1].encode()) for q in sub if q)
        children = sum(1 for q in nodes if len(q) == len(p) + 1 and q[:-1] == p)
        ends = ",".join(str(c) for c in sorted(c for c in members if paths[c] == p))
        out.append((min(members), len(p), min(nodes[p[:-1]]) if p else None, len(members), children, len(leaves), saved, sha(ends)))
    return sorted(out, key=str)


def turns_of(rows):
    by = {}
    for c, t, r, x in rows:
        if c is not None:
            r, x = r or "", x or ""
            tid = f"{len(x.encode())}:" + sha(f"{len(r.encode())}:{r}{x}")[:32]
            by.setdefault(c, []).append((t is not None, t or 0, tid, r, x))
    return {c: tuple(v[3:] for v in sorted(vs)) for c, vs in by.items()}


def rebuild(paths):
    out = {}
    for c, own in paths.items():
        h = zlib.crc32(str(c).encode()) % 9
        out[c] = paths.get(c - c % 5, ())[:h] + own[h:]
    return out


SCHEMA = "conv_id long, turn long, role string, text string, pos string, tid int, t1 string"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "p", 1, "t") for r in rows], SCHEMA)


def trie_rows(df):
    return sorted([(r.conv_id, r.depth, r.parent_conv_id, r.n_convs, r.n_children, r.n_leaves, r.saved_tokens, r.ends_sha256)
                   for r in df.collect()], key=str)


def some_turns():
    rng = random.Random(12)
    rows = []
    for c in range(60):
        n = rng.choice([1, 2, 3, 5, 9])
        rows += [(c, t, rng.choice(["user", None, ""]), rng.choice(["é", "", None, "ab"])) for t in range(n)]
    rows += [(100, None, "user", "x"), (100, 1, "user", "y"), (100, 1, "user", "y"), (100, 1, "user", "a"), (None, 0, "user", "q")]
    rows += [(c, t, "user", "same") for c in (200, 203, 204) for t in range(7)] + [(201, t, "user", "same") for t in range(11)]
    rows += [(305, t, "user", f"long {t}") for t in range(40)]
    return rows


def test_trie_equals_brute_force(spark):
    rows = some_turns()
    paths = turns_of(rows)
    plain = prefix_trie.numbered(frame(spark, rows))
    assert trie_rows(prefix_trie.prefix_trie(plain, width=3)) == brute_trie(paths)
    built = prefix_trie.rebuilt(prefix_trie.numbered(frame(spark, rows)))
    assert trie_rows(prefix_trie.prefix_trie(built)) == brute_trie(rebuild(paths))


def test_trie_of_long_spread_conversations_and_none(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "_SPAN", 4)
    monkeypatch.setattr(prefix_trie, "_CHUNK", 3)
    rows = [(c, t, "u", "x") for c in range(8) for t in range(13)] + [(15, t, "u", f"{t}") for t in range(30)] + [(16, 0, "u", "z")]
    built = prefix_trie.rebuilt(prefix_trie.numbered(frame(spark, rows)))
    assert trie_rows(prefix_trie.prefix_trie(built, width=2)) == brute_trie(rebuild(turns_of(rows)))
    assert trie_rows(prefix_trie.prefix_trie(prefix_trie.rebuilt(prefix_trie.numbered(frame(spark, rows[:0] or []))))) == []


# --- Merkle manifest -------------------------------------------------------------------------------------------------


def up(nodes, f):
    levels = [nodes]
    while len(levels[-1]) > 1:
        below = levels[-1]
        levels.append([sha("".join(below[i:i + f])) for i in range(0, len(below), f)])
    return levels


def siblings(levels, i, f):
    out = []
    for nodes in levels[:-1]:
        begin = i - i % f
        out.append((i - begin, nodes[begin:i] + nodes[i + 1:begin + f]))
        i //= f
    return out


def brute_manifest(rows, f):
    by = {}
    for tree, key, leaf in rows:
        by.setdefault(tree, []).append((key is not None, key or 0, leaf))
    trees = sorted(by, key=lambda t: (t is not None, (t or "").encode()))
    levels = [up([x[2] for x in sorted(by[t])], f) for t in trees]
    top = up([lv[-1][0] for lv in levels], f)
    out = []
    for i, (t, lv) in enumerate(zip(trees, levels)):
        for j, x in enumerate(sorted(by[t])):
            proof = siblings(lv, j, f) + siblings(top, i, f)
            out.append((t, x[1] if x[0] else None, x[2], lv[-1][0], top[-1][0], [p[0] for p in proof], [p[1] for p in proof]))
    return sorted(out, key=str)


@pytest.mark.parametrize("fanout, depth, n", [(2, 1, 45), (2, 12, 45), (3, 2, 200), (2, 2, 1), (4, 1, 77)])
def test_manifest_equals_brute_force(spark, fanout, depth, n):
    rng = random.Random(fanout * 100 + n)
    rows = [(rng.choice(["en", "en", "en", "é", "", None]), rng.choice([i, i, None, 3]), sha(str(rng.randint(0, n)))) for i in range(n)]
    if n > 50:
        rows += [(f"lang{i}", 0, sha(str(i))) for i in range(9)]
    df = spark.createDataFrame([(*r, "x") for r in rows], "lang string, doc_id long, leaf string, extra string")
    out = merkle.merkle_manifest(df, "lang", ["doc_id"], ["lang", "doc_id"], fanout, depth)
    got = out.withColumn("folded", merkle.folded(merkle.F.col("leaf"))).collect()
    assert sorted([(r.lang, r.doc_id, r.leaf, r.subroot, r.root, r["at"], r.siblings) for r in got], key=str) == brute_manifest(rows, fanout)
    assert all(r.folded == r.root for r in got)


def test_op13_leaves_tampering_and_empty(spark, tmp_path):
    rows = [(i, "t" * i if i % 4 else None, ["en", "é", None][i % 3], None if i % 5 == 0 else "s", None if i % 6 == 0 else i) for i in range(40)]
    rows += [rows[9], (None, "no id", "en", "s", 5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    field = lambda v: "-" if v is None else f"{len(str(v).encode())}:{v}"
    leaf = lambda r, n: sha("".join(field(v) for v in (r[0], r[3], r[2], n, r[1])))
    want = brute_manifest([(r[2], r[0], leaf(r, r[4])) for r in rows], 2)
    got = merkle.op13_merkle_manifest(spark, str(tmp_path)).collect()
    assert sorted((str(r.doc_id), r.leaf, r.subroot, r.root, r.proof_sha256) for r in got) == sorted(
        (str(w[1]), w[2], w[3], w[4], sha("".join("".join(s) for s in w[6]))) for w in want)
    changed = {r[0] for r in rows if r[0] is not None and r[4] is not None and zlib.crc32(str(r[0]).encode()) % 7 == 0}
    assert changed and {r.doc_id for r in got if not r.verified} == changed
    assert all((r.folded_root == r.root) == r.verified for r in got)
    empty = merkle.merkle_manifest(docs.where("false").withColumn("leaf", merkle.F.lit("x")), "lang", ["doc_id"], ["doc_id"])
    assert empty.collect() == []

"""Quality rules by weak supervision, with DataFrame functions only: every rule votes good, bad or abstains;
expectation-maximisation over the counts of vote patterns estimates how often each rule is right; a document's
posterior probability of being good replaces "all rules must pass"."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.common import read_table, saved

SPACE = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]"
SPACES = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
ROUNDS = 12
#: What is held before any vote is counted: the share of good documents, how often a rule is right on good ones, and on
#: bad ones (low: a bad document has one fault, which only some of the rules look for).
GOOD, HIT, MISS = 0.8, 0.97, 0.4
#: The weight that this keeps against a rule's votes: without it the fit turns to whatever votes hang together most (one
#: kind of fault) and calls all other faults good.
WEIGHT = 0.2

#: name, value, bad when, good when: (low, high) means outside low..high is bad; one number means above is bad.
#: Fixed thresholds; between bad and good a rule abstains.
RULES = (
    ("symbols", "n_symbols / n_words", (">", 0.1), ("<=", 0.02)),
    ("symbol_share", "n_symbols / word_chars", (">", 0.03), ("<=", 0.005)),
    ("repeated_words", "n_repeat_words / n_words", (">", 0.3), ("<=", 0.1)),
    ("repeated_lines", "n_dup_lines / n_lines", (">", 0.3), ("<=", 0.0)),
    ("word_length", "abs(word_chars / n_words - 6.0)", (">", 4.0), ("<=", 2.5)),
    ("upper_case", "n_upper / word_chars", (">", 0.3), ("<=", 0.12)),
    ("exclamations", "n_exclaim / n_words", (">", 0.3), ("<=", 0.05)),
)


def _let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def repeated_window_words(words: Column, size: int = 3) -> Column:
    """How many words lie in a window of ``size`` words that occurs twice or more (64-bit window hashes)."""

    def of_hashes(h):
        def of_sorted(s):
            same = lambda x, j: (F.get(s, j - 1)["h"] == x["h"]) | (F.get(s, j + 1)["h"] == x["h"])
            hits = F.transform(s, lambda x, j: F.when(F.coalesce(same(x, j), F.lit(False)), x["i"]))
            return _let(F.sort_array(F.filter(hits, lambda i: i.isNotNull())), lambda d: F.aggregate(
                F.transform(d, lambda i, j: F.least(F.lit(size), F.coalesce(F.get(d, j + 1) - i, F.lit(size)))),
                F.lit(0), lambda a, x: a + x))

        pairs = F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i")))
        return F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(_let(F.sort_array(pairs), of_sorted))

    def of_words(w):
        starts = F.slice(w, F.lit(1), F.greatest(F.size(w) - (size - 1), F.lit(0)))
        hashes = F.transform(starts, lambda x, i: F.xxhash64(x, *(F.get(w, i + k) for k in range(1, size))))
        return _let(hashes, of_hashes)

    return _let(words, of_words)


def text_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per text: words, code points in words, symbols, lines with a word, such lines equal to an earlier one, words in
    repeated three-word windows, upper-case letters, exclamation marks.  A null text has none of them."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col), text.alias("t"))
    length = lambda c: F.length(c).cast("long")
    lines = F.filter(F.split("t", "\n", -1), lambda x: x.rlike(WORD))
    return rows.select(
        id_col,
        F.filter(F.split("t", SPACE + "+", -1), lambda w: w != "").alias("words"),
        _let(lines, lambda x: F.struct(F.size(x).alias("n"), F.size(F.array_distinct(x)).alias("d"))).alias("lines"),
        length(F.translate("t", SPACES, "")).alias("word_chars"),
        (length("t") - length(F.translate("t", SYMBOLS, ""))).alias("n_symbols"),
        length(F.regexp_replace("t", r"\P{Lu}+", "")).alias("n_upper"),
        (length("t") - length(F.replace("t", F.lit("!"), F.lit("")))).alias("n_exclaim"),
    ).select(
        id_col, F.size("words").cast("long").alias("n_words"), "word_chars", "n_symbols",
        (F.col("lines.n") - F.col("lines.d")).cast("long").alias("n_dup_lines"),
        repeated_window_words(F.col("words")).cast("long").alias("n_repeat_words"),
        F.col("lines.n").cast("long").alias("n_lines"), "n_upper", "n_exclaim")


def rule_votes(counts: DataFrame) -> DataFrame:
    """``counts`` with one column per rule: 1 good, 0 bad, null where the rule abstains (or divides by zero)."""
    votes = {}
    for name, value, (bad, b), (good, g) in RULES:
        votes[name] = F.expr(f"CASE WHEN {_safe(value)} {bad} {b} THEN 0 WHEN {_safe(value)} {good} {g} THEN 1 END")
    return counts.withColumns(votes)


def _safe(value: str) -> str:
    """The value in double precision; null where it would divide by zero."""
    for d in ("n_words", "n_lines", "word_chars"):
        value = value.replace(f"/ {d}", f"/ nullif(cast({d} AS DOUBLE), 0)")
    return f"({value})"


def fit_rules(votes: DataFrame, rounds: int = ROUNDS) -> list[float]:
    """Prior, then per rule how often it votes good on good documents and bad on bad ones.

    The rows are first counted by vote pattern (at most ``3 ** len(RULES)`` patterns); each round is one aggregate
    over that small table, of which the driver sees one row of numbers.
    """
    names = [r[0] for r in RULES]
    patterns = saved(votes.groupBy(*names).agg(F.count("*").alias("n")).coalesce(1), "vote-patterns")
    theta = [GOOD] + [HIT, MISS] * len(names)
    for _ in range(rounds):
        p, n = F.col("p"), F.col("n")
        means = [_mean(n * p, n, GOOD, F.lit(1.0))]
        for v in names:
            cast, prior = F.col(v).isNotNull(), WEIGHT * F.sum(F.when(F.col(v).isNotNull(), n))
            means += [_mean(F.when(F.col(v) == 1, n * p), F.when(cast, n * p), HIT, prior),
                      _mean(F.when(F.col(v) == 0, n * (1 - p)), F.when(cast, n * (1 - p)), MISS, prior)]
        theta = list(patterns.withColumn("p", posterior(theta)).agg(*means).first())
    return theta


def _mean(hits: Column, votes: Column, held: float, weight: Column) -> Column:
    """The share of hits, with ``held`` as if it came from ``weight`` votes more; ``held`` itself without any vote."""
    zero = F.lit(0.0)
    total = F.coalesce(F.sum(votes), zero) + F.coalesce(weight, zero)
    return F.coalesce((F.coalesce(F.sum(hits), zero) + held * F.coalesce(weight, zero)) / F.nullif(total, zero), F.lit(held))


def posterior(theta: list[float]) -> Column:
    """Probability that a document is good, given its votes."""
    good, bad = F.lit(theta[0]), F.lit(1 - theta[0])
    for i, (name, *_) in enumerate(RULES):
        hit, miss = theta[1 + 2 * i], theta[2 + 2 * i]
        v = F.col(name)
        good = good * F.when(v == 1, hit).when(v == 0, 1 - hit).otherwise(1.0)
        bad = bad * F.when(v == 1, 1 - miss).when(v == 0, miss).otherwise(1.0)
    return good / (good + bad)


def quality_by_rules(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: its counts, ``base_failed``, ``posterior`` and ``kept``.

    ``base_failed``: under 50 words, or over half its words in repeated three-word windows.  ``kept``: not
    ``base_failed``, and the posterior is at least one half.  Null, empty and blank texts have no words and fail.
    The rules are fitted on all rows, repeated rows each counting; an empty table gives no rows.  Other columns are
    ignored; ids are passed on as they are, nulls too.
    """
    counts = saved(text_counts(docs, id_col, text_col), "rule-counts")
    votes = rule_votes(counts)
    theta = fit_rules(votes)
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return votes.select(id_col, "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                        failed.alias("base_failed"), posterior(theta).alias("posterior"),
                        (~failed & (posterior(theta) >= 0.5)).alias("kept"))


def op5_quality_rules(spark, sf_dir: str) -> DataFrame:
    return quality_by_rules(read_table(spark, sf_dir, "documents")).drop("posterior")


def _sql() -> str:
    """The same rules and rounds in DuckDB: one pair of steps per round."""
    names = [r[0] for r in RULES]
    votes = ",\n".join(
        f"CASE WHEN {_safe(value)} {bad} {b} THEN 0 WHEN {_safe(value)} {good} {g} THEN 1 END AS {name}"
        for name, value, (bad, b), (good, g) in RULES)

    def post(t: str) -> str:
        good, bad = f"{t}.t0", f"(1 - {t}.t0)"
        for i, v in enumerate(names):
            a, m = f"{t}.t{1 + 2 * i}", f"{t}.t{2 + 2 * i}"
            good += f" * CASE WHEN {v} = 1 THEN {a} WHEN {v} = 0 THEN 1 - {a} ELSE 1 END"
            bad += f" * CASE WHEN {v} = 1 THEN 1 - {m} WHEN {v} = 0 THEN {m} ELSE 1 END"
        return f"({good}) / ({good} + {bad})"

    first = [GOOD] + [HIT, MISS] * len(names)
    steps = ["th0 AS MATERIALIZED (SELECT " + ", ".join(f"{x}::DOUBLE AS t{i}" for i, x in enumerate(first)) + ")"]

    def mean(hits, votes, held, weight):
        w = f"coalesce({weight}, 0)"
        return f"coalesce((coalesce(sum({hits}), 0) + {held} * {w}) / nullif(coalesce(sum({votes}), 0) + {w}, 0), {held})"

    for r in range(ROUNDS):
        cols = [mean("n * p", "n", GOOD, "1.0::DOUBLE") + " AS t0"]
        for i, v in enumerate(names):
            cast = f"CASE WHEN {v} IS NOT NULL THEN"
            held = f"{WEIGHT} * sum({cast} n END)"
            cols.append(mean(f"CASE WHEN {v} = 1 THEN n * p END", f"{cast} n * p END", HIT, held) + f" AS t{1 + 2 * i}")
            cols.append(mean(f"CASE WHEN {v} = 0 THEN n * (1 - p) END", f"{cast} n * (1 - p) END", MISS, held) + f" AS t{2 + 2 * i}")
        steps.append(f"th{r + 1} AS MATERIALIZED (SELECT {', '.join(cols)} FROM (SELECT pat.*, {post(f'th{r}')} AS p FROM pat, th{r}))")
    end = f"th{ROUNDS}"
    return rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT doc_id, t, list_filter(string_split_regex(t, '{SPACE}+'), lambda x: x <> '') AS words,
             list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '{WORD}')) AS lines FROM d),
g AS (SELECT doc_id, i, words[i] || ' ' || words[i + 1] || ' ' || words[i + 2] AS s
      FROM (SELECT doc_id, words, unnest(range(1, len(words) - 1)) AS i FROM w)),
h AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, s) AS n FROM g) WHERE n > 1),
r AS (SELECT doc_id, count(DISTINCT i + k) AS n_repeat_words FROM h, range(3) z(k) GROUP BY doc_id),
c AS MATERIALIZED (
  SELECT doc_id, len(words)::BIGINT AS n_words,
         length(regexp_replace(t, '{SPACE}', '', 'g')) AS word_chars,
         length(t) - length(regexp_replace(t, '[{SYMBOLS}]', '', 'g')) AS n_symbols,
         (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
         coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words, len(lines)::BIGINT AS n_lines,
         length(regexp_replace(t, '\P{{Lu}}', '', 'g')) AS n_upper,
         length(t) - length(replace(t, '!', '')) AS n_exclaim
  FROM w LEFT JOIN r USING (doc_id)),
v AS MATERIALIZED (SELECT *, {votes} FROM c),
pat AS MATERIALIZED (SELECT {', '.join(names)}, count(*)::DOUBLE AS n FROM v GROUP BY ALL),
{(',' + chr(10)).join(steps)}
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND {post(end)} >= 0.5 AS kept
FROM (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM v), {end}
"""


OP5_SQL = _sql()

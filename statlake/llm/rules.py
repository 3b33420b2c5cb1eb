"""Quality rules (operator 5): a ledger of failure bits, policies applied later.

Every rule is evaluated once per document; the ledger keeps the
measurements and one bit for each failed rule. A policy is a version and the
rules it enforces, so changing a policy, or asking what a rule costs
(ablation), reads the ledger's bits and never the texts. Native expressions only.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from statlake.llm.common import WORD, pick

#: rule -> when it fails, over the ledger's measurements; a rule's bit is its
#: place in this list, so new rules go to the end.
RULES: dict[str, str] = {
    "few_words": "n_words < 20",
    "repeated_windows": "100 * n_repeat_words > 30 * n_words",
    "symbols": "10 * n_symbols > n_words",
    "exclamations": "10 * n_exclaim > n_words",
    "capitals": "10 * n_capitals > 3 * word_chars",
    "word_length": "word_chars > 12 * n_words OR word_chars < 2 * n_words",
    "repeated_lines": "10 * n_dup_lines > 3 * n_lines AND n_dup_lines > 1",
    "few_distinct_words": "100 * n_distinct_words < 35 * n_words AND n_words < 1000",
}
BASE = ("few_words", "repeated_windows")
#: policy version -> rules enforced
POLICIES: dict[str, Sequence[str]] = {
    "v1": (*BASE, "symbols", "exclamations", "capitals", "repeated_lines"),
    "v2": tuple(RULES),
}
MEASUREMENTS = (
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
    "n_lines", "n_exclaim", "n_capitals", "n_distinct_words",
)


def _let(name: str, value: str, body: str) -> str:
    """SQL for ``body`` with ``name`` bound to ``value``, evaluated once per row."""
    return f"transform(array({value}), {name} -> {body})[0]"


def _removed(text: str, chars: str) -> str:
    quoted = chars.replace("\\", "\\\\").replace("'", "\\'")
    return f"(char_length({text}) - char_length(translate({text}, '{quoted}', '')))"


def repeat_words_sql(words: str, window: int = 8) -> str:
    """Words inside ``window``-word windows that occur twice or more in ``words``.

    Windows are compared by 64-bit hashes. If all are distinct the count is 0;
    else the starts of repeated windows, in order, each cover the words up to
    the next such start, ``window`` at most.
    """
    starts = f"sequence(0, size({words}) - {window})"
    hashes = f"transform({starts}, i -> xxhash64(slice({words}, i + 1, {window})))"
    # equal hashes stand side by side once sorted with their places
    pairs = "array_sort(transform(h, (x, i) -> struct(x AS x, i AS i)))"
    twice = "filter(s, (x, i) -> (i > 0 AND s[greatest(i - 1, 0)].x = x.x) OR (i < size(s) - 1 AND s[least(i + 1, size(s) - 1)].x = x.x))"
    covered = f"aggregate(transform(q, (x, i) -> CASE WHEN i < size(q) - 1 THEN least(q[least(i + 1, size(q) - 1)] - x, {window}) ELSE {window} END), 0, (a, x) -> a + x)"
    places = _let("s", pairs, f"array_sort(transform({twice}, x -> x.i))")
    count = _let("q", places, covered)
    some = _let("h", hashes, f"CASE WHEN size(array_distinct(h)) = size(h) THEN 0 ELSE {count} END")
    return f"CASE WHEN size({words}) < {window} THEN 0 ELSE {some} END"


def rule_ledger(docs: DataFrame, rules: Mapping[str, str] = RULES) -> DataFrame:
    """``doc_id``, the measurements, and ``failed``: bit k set when rule k fails.

    Words are runs outside ASCII white space, taken from the whole text.

    * NULL or empty text: all counts 0 (and so ``few_words`` fails).
    * NULL ``doc_id`` stays; repeated rows give repeated rows; an empty table
      an empty one; other columns are ignored, whatever their names.
    """
    text = F.coalesce("text", F.lit(""))
    rows = pick(docs, {"doc_id": "bigint", "text": "string"}).select("doc_id", text.alias("t"))
    spaces = " \t\n\x0b\x0c\r"
    lines = _let(
        "l", f"filter(split(t, '\\n', -1), x -> rlike(x, '{_java(WORD)}'))", "named_struct('n', size(l), 'd', size(l) - size(array_distinct(l)))"
    )
    per_words = (
        f"named_struct('n', size(w), 'd', size(array_distinct(w)), 'r', {repeat_words_sql('w')})"
    )
    rows = rows.selectExpr(
        "doc_id",
        _let("w", f"regexp_extract_all(t, '{_java(WORD)}', 0)", per_words) + " AS ws",
        f"{lines} AS ls",
        f"char_length(translate(t, '{spaces}', '')) AS word_chars",
        f"{_removed('t', '#*$%&|<>')} AS n_symbols",
        f"{_removed('t', '!')} AS n_exclaim",
        f"{_removed('t', 'ABCDEFGHIJKLMNOPQRSTUVWXYZ')} AS n_capitals",
    )
    where = {"n_words": "ws.n", "n_distinct_words": "ws.d", "n_repeat_words": "ws.r", "n_lines": "ls.n", "n_dup_lines": "ls.d"}
    rows = rows.selectExpr("doc_id", *[f"cast({where.get(m, m)} AS bigint) AS {m}" for m in MEASUREMENTS])
    bits = " | ".join(f"(CASE WHEN {test} THEN {1 << k}L ELSE 0L END)" for k, test in enumerate(rules.values()))
    return rows.withColumn("failed", F.expr(bits))


def _java(pattern: str) -> str:
    return pattern.replace("\\", "\\\\")


def mask(names: Sequence[str], rules: Mapping[str, str] = RULES) -> int:
    order = list(rules)
    return sum(1 << order.index(n) for n in set(names))


def passes(policy: str, policies: Mapping[str, Sequence[str]] = POLICIES, rules: Mapping[str, str] = RULES) -> Column:
    """Whether a ledger row fails none of the rules the policy version enforces."""
    return F.col("failed").bitwiseAND(F.lit(mask(policies[policy], rules))) == 0


def ablation(ledger: DataFrame, policy: str, policies: Mapping[str, Sequence[str]] = POLICIES, rules: Mapping[str, str] = RULES) -> DataFrame:
    """Per enforced rule: ``failing`` documents, those failing it ``alone`` (which
    would be kept without it), and ``kept`` by the policy less that rule.

    Computed from counts per bit pattern, at most 2^rules rows.
    """
    full = mask(policies[policy], rules)
    patterns = ledger.groupBy(F.col("failed").bitwiseAND(F.lit(full)).alias("bits")).agg(F.count(F.lit(1)).alias("n"))
    each = F.explode(F.array(*[F.struct(F.lit(n).alias("rule"), F.lit(mask([n], rules)).alias("bit")) for n in policies[policy]]))
    rows = patterns.select("bits", "n", each.alias("r")).select("bits", "n", "r.rule", "r.bit")
    count = lambda test: F.sum(F.when(test, F.col("n")).otherwise(0))
    return rows.groupBy("rule").agg(
        count(F.col("bits").bitwiseAND(F.col("bit")) != 0).alias("failing"),
        count(F.col("bits") == F.col("bit")).alias("alone"),
        count(F.col("bits").bitwiseAND(F.bitwise_not(F.col("bit"))) == 0).alias("kept"),
    )


def quality_rules(docs: DataFrame, policy: str = "v2") -> DataFrame:
    """The ledger with ``base_failed`` and the policy's verdict ``kept``."""
    ledger = rule_ledger(docs)
    base = F.col("failed").bitwiseAND(F.lit(mask(BASE))) != 0
    return ledger.withColumn("base_failed", base).withColumn("kept", ~base & passes(policy))


# DuckDB SQL for quality_rules(documents, "v2"), written out on its own.
ORACLE = r"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents),
w AS (
  SELECT rid, doc_id, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS ws,
         list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls
  FROM d),
win AS (
  SELECT rid, i, list_slice(ws, i, i + 7) AS g
  FROM (SELECT rid, ws, unnest(range(1, len(ws) - 6)) AS i FROM w WHERE len(ws) >= 8)),
twice AS (SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, g) AS c FROM win) WHERE c > 1),
cover AS (
  SELECT rid, sum(least(8, coalesce(after - i, 8))) AS n
  FROM (SELECT rid, i, lead(i) OVER (PARTITION BY rid ORDER BY i) AS after FROM twice) GROUP BY rid),
m AS (
  SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(length(array_to_string(ws, '')) AS BIGINT) AS word_chars,
         CAST(length(t) - length(translate(t, '#*$%&|<>', '')) AS BIGINT) AS n_symbols,
         CAST(len(ls) - len(list_distinct(ls)) AS BIGINT) AS n_dup_lines,
         CAST(coalesce(cover.n, 0) AS BIGINT) AS n_repeat_words, CAST(len(ls) AS BIGINT) AS n_lines,
         CAST(length(t) - length(replace(t, '!', '')) AS BIGINT) AS n_exclaim,
         CAST(length(t) - length(translate(t, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', '')) AS BIGINT) AS n_capitals,
         CAST(len(list_distinct(ws)) AS BIGINT) AS n_distinct_words
  FROM w LEFT JOIN cover ON cover.rid = w.rid),
f AS (
  SELECT *, CAST(
      (n_words < 20)::BIGINT + 2 * (100 * n_repeat_words > 30 * n_words)::BIGINT + 4 * (10 * n_symbols > n_words)::BIGINT
      + 8 * (10 * n_exclaim > n_words)::BIGINT + 16 * (10 * n_capitals > 3 * word_chars)::BIGINT
      + 32 * (word_chars > 12 * n_words OR word_chars < 2 * n_words)::BIGINT
      + 64 * (10 * n_dup_lines > 3 * n_lines AND n_dup_lines > 1)::BIGINT
      + 128 * (100 * n_distinct_words < 35 * n_words AND n_words < 1000)::BIGINT AS BIGINT) AS failed
  FROM m)
SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed, failed = 0 AS kept FROM f
"""

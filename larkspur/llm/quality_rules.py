"""Quality rules as weak supervision.

Each rule votes a text good or bad or abstains. Expectation-maximisation
over the counts of vote patterns estimates how often each rule is right on good
and on bad texts, without labels, and a text is kept if its posterior
probability of being good is at least one half. Everything that looks at a text
is a column expression; the iteration sees at most ``3 ** len(RULES)`` patterns.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larkspur.functions.arrays import once
from larkspur.llm.registry import query, table
from larkspur.llm.words import BLANKS, UPPER, chars_of, chars_without, words
from larkspur.session import materialize

SYMBOLS = "#*$%&|<>"
WINDOW = 8
ROUNDS = 15  # of expectation-maximisation
SMOOTH = 4.0  # pseudo-votes behind each first guess
GUESS = 0.9  # of a rule's accuracy, and of the share of good texts

# Rules as SQL conditions over the signals; a text that meets neither is an abstention.
RULES = [
    ("length", "n_words < 20", "n_words >= 50"),
    ("word_length", "word_chars > 14 * n_words OR word_chars < 2 * n_words",
     "word_chars <= 10 * n_words AND word_chars >= 3 * n_words"),
    ("symbols", "100 * n_symbols > 5 * word_chars", "100 * n_symbols <= word_chars"),
    ("lines", "100 * n_dup_lines > 30 * n_lines", "n_lines >= 2 AND n_dup_lines = 0"),
    ("repeats", "100 * n_repeat_words > 20 * n_words", "100 * n_repeat_words <= 5 * n_words"),
    ("capitals", "100 * n_upper > 30 * word_chars", "100 * n_upper <= 15 * word_chars"),
    ("shouting", "100 * n_shouts > 10 * n_words", "100 * n_shouts <= 2 * n_words"),
]
BASE_FAILED = "n_words < 20 OR 100 * n_repeat_words > 30 * n_words"
SIGNALS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_shouts")


def repeated_words(tokens: Column, window: int = WINDOW) -> Column:
    """Words that lie in a window of ``window`` words found twice or more in the text.

    Windows are told apart by 64-bit hashes. Texts without a repeated window end at
    one hash set; the others sort their windows, so the work is never quadratic.
    """

    def covered(hashes: Column) -> Column:
        """From the window hashes, in order."""
        pairs = F.array_sort(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

        def starts(p: Column) -> Column:
            twice = lambda e, i: (e["h"] == F.get(p, i - 1)["h"]) | (e["h"] == F.get(p, i + 1)["h"])
            spots = F.transform(p, lambda e, i: F.when(F.coalesce(twice(e, i), F.lit(False)), e["i"]))
            return F.array_sort(F.filter(spots, lambda s: s.isNotNull()))

        def reach(s: Column) -> Column:
            width = lambda at, i: F.least(F.coalesce(F.get(s, i + 1) - at, F.lit(window)), F.lit(window))
            return F.aggregate(F.transform(s, width), F.lit(0), lambda a, x: a + x)

        return once(once(pairs, starts), reach)

    def of_hashes(h: Column) -> Column:
        last = F.size(h) - window
        windows = F.transform(
            F.sequence(F.lit(0), last), lambda i: F.xxhash64(*[F.get(h, i + k) for k in range(window)])
        )
        some = once(windows, lambda w: F.when(F.size(F.array_distinct(w)) < F.size(w), covered(w)).otherwise(0))
        return F.when(last < 1, 0).otherwise(some)

    return once(F.transform(tokens, lambda t: F.xxhash64(t)), of_hashes).cast("bigint")


def text_signals(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` plus the columns of ``SIGNALS``; all 0 for a null or empty text."""
    whole = F.coalesce(F.col(text), F.lit(""))
    lines = F.filter(F.split(whole, "\n", -1), lambda x: chars_without(x, BLANKS) > 0)

    def of_words(tokens: Column) -> Column:
        return F.struct(F.size(tokens).cast("bigint").alias("n_words"), repeated_words(tokens).alias("n_repeat_words"))

    def of_lines(found: Column) -> Column:
        same = F.size(found) - F.size(F.array_distinct(found))
        return F.struct(F.size(found).cast("bigint").alias("n_lines"), same.cast("bigint").alias("n_dup_lines"))

    named = {
        "_w": once(words(whole), of_words),
        "_l": once(lines, of_lines),
        "word_chars": chars_without(whole, BLANKS).cast("bigint"),
        "n_symbols": chars_of(whole, SYMBOLS).cast("bigint"),
        "n_upper": chars_of(whole, UPPER).cast("bigint"),
        "n_shouts": chars_of(whole, "!").cast("bigint"),
    }
    kept = [c for c in docs.columns if c not in {*SIGNALS, *named}]
    found = docs.select(*kept, *[v.alias(k) for k, v in named.items()])
    inner = {"n_words": "_w", "n_repeat_words": "_w", "n_lines": "_l", "n_dup_lines": "_l"}
    return found.select(*kept, *[F.col(inner[s])[s].alias(s) if s in inner else F.col(s) for s in SIGNALS])


def votes() -> list[Column]:
    """1 for good, 0 for bad, null for an abstention; one column for each rule."""
    return [F.when(F.expr(bad), 0).when(F.expr(good), 1).alias(f"v{j}") for j, (_, bad, good) in enumerate(RULES)]


@dataclass
class VoteModel:
    """Share of good texts; per rule how often its vote is right on good and on bad texts."""

    prior: float
    on_good: list[float]
    on_bad: list[float]

    def weights(self) -> list[tuple[float, float]]:
        """Per rule the log odds that a good vote and a bad vote add."""
        return [(math.log(a / (1 - b)), math.log((1 - a) / b)) for a, b in zip(self.on_good, self.on_bad)]

    def log_odds(self, pattern) -> float:
        """A pattern has 1, 0 or None for each rule."""
        total = math.log(self.prior / (1 - self.prior))
        for vote, (good, bad) in zip(pattern, self.weights()):
            total += 0.0 if vote is None else good if vote else bad
        return total

    def posterior(self) -> Column:
        """Of the columns that :func:`votes` names."""
        total = F.lit(math.log(self.prior / (1 - self.prior)))
        for j, (good, bad) in enumerate(self.weights()):
            total = total + F.when(F.col(f"v{j}") == 1, good).when(F.col(f"v{j}") == 0, bad).otherwise(0.0)
        return 1 / (1 + F.exp(-total))


def fit_votes(patterns: list[tuple[tuple, int]], n_rules: int, rounds: int = ROUNDS) -> VoteModel:
    """Expectation-maximisation over (votes, number of texts) rows."""
    model = VoteModel(GUESS, [GUESS] * n_rules, [GUESS] * n_rules)
    total = sum(n for _, n in patterns)
    for _ in range(rounds):
        good = [n / (1 + math.exp(-model.log_odds(p))) for p, n in patterns]
        prior = (sum(good) + SMOOTH * GUESS) / (total + SMOOTH)
        on_good, on_bad = [], []
        for j in range(n_rules):
            said = [(g, n - g, p[j]) for (p, n), g in zip(patterns, good) if p[j] is not None]
            right = sum(g for g, _, v in said if v == 1) + SMOOTH * GUESS
            on_good.append(right / (sum(g for g, _, _ in said) + SMOOTH))
            right = sum(b for _, b, v in said if v == 0) + SMOOTH * GUESS
            on_bad.append(right / (sum(b for _, b, _ in said) + SMOOTH))
        model = VoteModel(prior, on_good, on_bad)
    return model


def judge_quality(docs: DataFrame, text: str = "text", keep: Sequence[str] | None = None) -> DataFrame:
    """Columns ``keep`` of ``docs`` (all by default) plus the signals, ``base_failed``, ``posterior`` and ``kept``.

    A row for each row. What is kept and the signals are written down, so that texts are read once.
    A null or empty text has no words and fails the base rule. Repeated rows count
    as often as they occur. An empty table stays empty. Columns of ``docs`` with the
    names of the new ones are replaced.
    """
    names = [f"v{j}" for j in range(len(RULES))]
    own = [c for c in keep or docs.columns if c not in {*SIGNALS, *names, "base_failed", "posterior", "kept"}]
    signals = text_signals(docs.select(*dict.fromkeys([*own, text])), text)
    voted = materialize(signals.select(*own, *SIGNALS, *votes()), "signals")
    counted = voted.groupBy(*names).agg(F.count(F.lit(1)).alias("n")).orderBy(*names).collect()
    model = fit_votes([(tuple(r[v] for v in names), r["n"]) for r in counted], len(RULES))
    return voted.select(
        *own,
        *SIGNALS,
        F.expr(BASE_FAILED).alias("base_failed"),
        model.posterior().alias("posterior"),
    ).withColumn("kept", ~F.col("base_failed") & (F.col("posterior") >= 0.5))


def _em_sql() -> str:
    """The iteration as one SQL step for each round over the counted patterns."""
    n = len(RULES)
    first = ", ".join(f"{GUESS}::DOUBLE AS a{j}, {GUESS}::DOUBLE AS b{j}" for j in range(n))
    steps = [f"m0 AS (SELECT {GUESS}::DOUBLE AS prior, {first})"]
    for r in range(ROUNDS):
        odds = " + ".join(
            ["ln(prior / (1 - prior))"]
            + [f"CASE v{j} WHEN 1 THEN ln(a{j} / (1 - b{j})) WHEN 0 THEN ln((1 - a{j}) / b{j}) ELSE 0 END" for j in range(n)]
        )
        parts = ", ".join(
            f"(coalesce(sum(g) FILTER (v{j} = 1), 0) + {SMOOTH * GUESS}) / (coalesce(sum(g) FILTER (v{j} IS NOT NULL), 0) + {SMOOTH}) AS a{j}, "
            f"(coalesce(sum(n - g) FILTER (v{j} = 0), 0) + {SMOOTH * GUESS}) / (coalesce(sum(n - g) FILTER (v{j} IS NOT NULL), 0) + {SMOOTH}) AS b{j}"
            for j in range(n)
        )
        steps.append(f"e{r} AS MATERIALIZED (SELECT p.*, n / (1 + exp(-({odds}))) AS g FROM p CROSS JOIN m{r})")
        steps.append(f"m{r + 1} AS MATERIALIZED (SELECT (sum(g) + {SMOOTH * GUESS}) / (sum(n) + {SMOOTH}) AS prior, {parts} FROM e{r})")
    return ",\n".join(steps)


def _oracle() -> str:
    n = len(RULES)
    cases = ", ".join(f"CASE WHEN {bad} THEN 0 WHEN {good} THEN 1 END AS v{j}" for j, (_, bad, good) in enumerate(RULES))
    names = ", ".join(f"v{j}" for j in range(n))
    odds = " + ".join(
        ["ln(prior / (1 - prior))"]
        + [f"CASE v{j} WHEN 1 THEN ln(a{j} / (1 - b{j})) WHEN 0 THEN ln((1 - a{j}) / b{j}) ELSE 0 END" for j in range(n)]
    )
    word = r"[^\x20\x09-\x0D]+"
    return f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT r, regexp_extract_all(t, '{word}') AS w FROM d),
x AS (SELECT r, i, array_to_string(w[i:i + {WINDOW - 1}], ' ') AS s
      FROM (SELECT r, w, unnest(generate_series(1, len(w) - {WINDOW - 1})) AS i FROM w)),
y AS (SELECT r, unnest(a) AS i FROM (SELECT r, list(i) AS a FROM x GROUP BY r, s HAVING count(*) > 1)),
c AS (SELECT r, count(DISTINCT i + k) AS n_repeat_words FROM y CROSS JOIN (SELECT unnest(range({WINDOW})) AS k) GROUP BY r),
l AS (SELECT r, count(*) AS n_lines, count(*) - count(DISTINCT l) AS n_dup_lines
      FROM (SELECT r, unnest(string_split(t, chr(10))) AS l FROM d) WHERE regexp_matches(l, '{word}') GROUP BY r),
s AS (SELECT doc_id, len(w) AS n_words, length(regexp_replace(t, '[\\x20\\x09-\\x0D]+', '', 'g')) AS word_chars,
             length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS n_symbols,
             coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words, coalesce(n_lines, 0) AS n_lines,
             length(t) - length(regexp_replace(t, '[A-Z]', '', 'g')) AS n_upper, length(t) - length(replace(t, '!', '')) AS n_shouts
      FROM d JOIN w USING (r) LEFT JOIN c USING (r) LEFT JOIN l USING (r)),
v AS MATERIALIZED (SELECT *, {cases} FROM s),
p AS MATERIALIZED (SELECT {names}, count(*) AS n FROM v GROUP BY ALL),
{_em_sql()}
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, ({BASE_FAILED}) AS base_failed,
       NOT ({BASE_FAILED}) AND 1 / (1 + exp(-({odds}))) >= 0.5 AS kept
FROM v CROSS JOIN m{ROUNDS}
"""


@query("op5_quality_rules", _oracle())
def op5_quality_rules(spark, sf_dir):
    """Signals, base rule and the method's verdict for every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return judge_quality(docs, keep=["doc_id"]).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )

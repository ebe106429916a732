"""Quality rules: base statistics of whole texts, and a decision list learned from labelled documents.

Everything is column expressions and aggregates. Learning is sequential covering: a rule for the poor class grows one
threshold condition at a time by information gain on two thirds of the labelled rows, is pruned on the other third, and
the rows it covers leave before the next rule grows. What reaches the driver is a histogram of features x thresholds.

Null text counts as empty. Rows with a null id are judged like others; only labels join by id. Repeated rows get equal
verdicts. Without labels (or with one class only) no rule is learned and every text that passes the base rules is kept.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from math import log2

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daybook.llm.common import free_name, let, split_words, staged

SYMBOLS = "#*$%&|<>"
SPACES = " \t\n\x0b\x0c\r"
PARTS = {
    "w": ("n_words", "n_repeat_words"),
    "m": ("word_chars", "n_symbols", "n_bangs"),
    "l": ("n_dup_lines", "n_lines"),
}
FEATURES = ("n_words", "word_length", "symbol_share", "bang_share", "dup_line_share", "repeat_share")


def _count_of(text: Column, characters: str) -> Column:
    return (F.length(text) - F.length(F.translate(text, characters, ""))).cast("long")


def _repeated_words(words: Column) -> Column:
    """Words inside 3-word windows that the text holds twice or more. Windows are compared by 64-bit hash."""

    def span(p: Column) -> Column:
        later = F.sequence(F.lit(1), F.size(p) - 1)
        return F.aggregate(later, F.lit(3), lambda n, j: n + F.least(F.lit(3), F.get(p, j) - F.get(p, j - 1)))

    def by_sorting(h: Column) -> Column:
        """Positions of windows seen twice: sort windows with their places, then compare neighbours."""

        def positions(s: Column) -> Column:
            same = F.filter(
                F.sequence(F.lit(0), F.size(s) - 1),
                lambda k: (F.get(s, k)["h"] == F.get(s, k - 1)["h"]) | (F.get(s, k)["h"] == F.get(s, k + 1)["h"]),
            )
            return F.sort_array(F.transform(same, lambda k: F.get(s, k)["p"]))

        return let(F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("p")))), positions)

    def covered(h: Column) -> Column:
        """The same positions; a text with few different repeats (the usual case) only looks those up."""

        def repeated(s: Column) -> Column:
            return F.transform(F.filter(F.sequence(F.lit(1), F.size(s) - 1), lambda k: F.get(s, k) == F.get(s, k - 1)), lambda k: F.get(s, k))

        def choose(d: Column) -> Column:
            few = F.filter(F.sequence(F.lit(0), F.size(h) - 1), lambda i: F.array_contains(d, F.get(h, i)))
            return F.when(F.size(d) <= 50, few).otherwise(by_sorting(h))

        return let(let(let(F.sort_array(h), repeated), choose), span)

    def of(w: Column) -> Column:
        windows = F.transform(
            F.sequence(F.lit(0), F.size(w) - 3), lambda i: F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2))
        )
        repeats = let(windows, lambda h: F.when(F.size(F.array_distinct(h)) < F.size(h), covered(h)).otherwise(0))
        return F.when(F.size(w) < 3, 0).otherwise(repeats)

    return of(words).cast("long")


def statistics(text: Column) -> Column:
    """Struct of the statistics of a text; every text is read whole."""
    text = F.coalesce(text, F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    # Runs of other characters are long, so taking them out is one cheap pass.
    marks = F.regexp_replace(text, r"[^#*$%&|<>!?]+", "")
    solid = reduce(lambda t, c: F.replace(t, F.lit(c), F.lit("")), SPACES, text)

    def of_words(w: Column) -> Column:
        return F.struct(F.size(w).cast("long").alias("n_words"), _repeated_words(w).alias("n_repeat_words"))

    def of_marks(m: Column) -> Column:
        return F.struct(
            F.length(solid).cast("long").alias("word_chars"),
            _count_of(m, SYMBOLS).alias("n_symbols"),
            _count_of(m, "!?").alias("n_bangs"),
        )

    def of_lines(x: Column) -> Column:
        return F.struct((F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"), F.size(x).cast("long").alias("n_lines"))

    return F.struct(let(split_words(text), of_words).alias("w"), let(marks, of_marks).alias("m"), let(lines, of_lines).alias("l"))


def flat(s: Column) -> Column:
    """The statistics as one flat struct."""
    return F.struct(*(s[part][c].alias(c) for part, names in PARTS.items() for c in names))


def base_failed(s: Column) -> Column:
    return (s["n_words"] < 50) | (100 * s["n_repeat_words"] > 50 * s["n_words"])


def features(s: Column) -> Column:
    """The numbers that rules put thresholds on, in the order of FEATURES."""
    per_word = lambda x: x / F.greatest(s["n_words"], F.lit(1))
    return F.array(
        s["n_words"].cast("double"),
        per_word(s["word_chars"]),
        per_word(s["n_symbols"]),
        per_word(s["n_bangs"]),
        s["n_dup_lines"] / F.greatest(s["n_lines"], F.lit(1)),
        per_word(s["n_repeat_words"]),
    )


@dataclass(frozen=True)
class Condition:
    feature: int
    at_least: bool
    threshold: float
    bin: int  # the threshold's place among those of its feature

    def holds(self, values: Column) -> Column:
        value = values[self.feature]
        return value >= self.threshold if self.at_least else value < self.threshold

    def holds_binned(self, bins: Column) -> Column:
        return bins[self.feature] >= self.bin if self.at_least else bins[self.feature] < self.bin

    def __str__(self) -> str:
        return f"{FEATURES[self.feature]} {'>=' if self.at_least else '<'} {self.threshold:g}"


Rule = tuple[Condition, ...]


def _all(conditions, values: Column, binned: bool) -> Column:
    tests = [c.holds_binned(values) if binned else c.holds(values) for c in conditions]
    return reduce(lambda a, b: a & b, tests, F.lit(True))


def _information(p: float, n: float) -> float:
    return log2(p / (p + n)) if p > 0 else -99.0


def learn(
    labelled: DataFrame,
    values: str = "values",
    poor: str = "poor",
    key: str = "doc_id",
    n_thresholds: int = 32,
    max_rules: int = 8,
    max_conditions: int = 3,
    min_precision: float = 0.9,
    min_covered: int = 3,
) -> list[Rule]:
    """Ordered rules for the poor class (``poor`` is 1) from an array of numbers per labelled row."""
    at = [F.percentile_approx(F.col(values)[i], [k / n_thresholds for k in range(1, n_thresholds)], 10_000).alias(f"t{i}") for i in range(len(FEATURES))]
    row = labelled.agg(*at).first()
    cuts = [sorted({float(t) for t in (row[f"t{i}"] or [])}) for i in range(len(FEATURES))]
    if not any(cuts):
        return []
    of_value = [sum((F.when(F.col(values)[i] >= t, 1).otherwise(0) for t in c), F.lit(0)) for i, c in enumerate(cuts)]
    rows = staged(
        labelled.select(F.array(*of_value).alias("bins"), F.col(poor).cast("int").alias("y"), (F.abs(F.xxhash64(key)) % 3 > 0).alias("grow")),
        "op2-bins",
    )
    rules: list[Rule] = []
    left = rows
    while len(rules) < max_rules:
        rule = _grow(left.filter("grow"), cuts, max_conditions)
        if not rule:
            break
        rule, p, n = _pruned(left.filter("not grow"), rule)
        if p < min_covered or p < min_precision * (p + n):
            break
        rules.append(rule)
        left = left.filter(~_all(rule, F.col("bins"), binned=True))
    return rules


def _grow(rows: DataFrame, cuts: list[list[float]], max_conditions: int) -> Rule:
    rule: Rule = ()
    while len(rule) < max_conditions:
        counts = (
            rows.filter(_all(rule, F.col("bins"), binned=True))
            .select("y", F.posexplode("bins").alias("feature", "bin"))
            .groupBy("feature", "bin")
            .agg(F.sum("y").alias("p"), F.sum(1 - F.col("y")).alias("n"))
            .collect()
        )
        hist = {(r["feature"], r["bin"]): (r["p"], r["n"]) for r in counts}
        total_p = sum(p for (f, _), (p, _) in hist.items() if f == 0)
        total_n = sum(n for (f, _), (_, n) in hist.items() if f == 0)
        if not total_p or not total_n:
            break
        best: tuple[float, Condition] | None = None
        for f, thresholds in enumerate(cuts):
            below_p = below_n = 0
            for k, t in enumerate(thresholds, 1):
                p, n = hist.get((f, k - 1), (0, 0))
                below_p, below_n = below_p + p, below_n + n
                for at_least, (x, y) in ((False, (below_p, below_n)), (True, (total_p - below_p, total_n - below_n))):
                    gain = x * (_information(x, y) - _information(total_p, total_n)) if x else 0
                    if gain > 1e-9 and (best is None or gain > best[0] + 1e-9):
                        best = gain, Condition(f, at_least, t, k)
        if best is None:
            break
        rule = (*rule, best[1])
    return rule


def _pruned(rows: DataFrame, rule: Rule) -> tuple[Rule, int, int]:
    """The prefix of the rule that does best on rows it did not grow on, and how many of each class that covers."""
    y, sums = F.col("y"), []
    for k in range(1, len(rule) + 1):
        hit = _all(rule[:k], F.col("bins"), binned=True)
        sums += [F.sum(F.when(hit, y).otherwise(0)).alias(f"p{k}"), F.sum(F.when(hit, 1 - y).otherwise(0)).alias(f"n{k}")]
    row = rows.agg(*sums).first()
    scored = [(((p := row[f"p{k}"] or 0) - (n := row[f"n{k}"] or 0)) / max(p + n, 1), -k, p, n) for k in range(1, len(rule) + 1)]
    _, minus_k, p, n = max(scored)
    return rule[:-minus_k], p, n


def decision(rules: list[Rule], values: Column) -> Column:
    """The number of the first rule that fires (from 1), else null: one ordered conditional expression."""
    out = F.lit(None).cast("int")
    for i, rule in reversed(list(enumerate(rules, 1))):
        out = F.when(_all(rule, values, binned=False), F.lit(i)).otherwise(out)
    return out


def judged_statistics(rows: DataFrame, labels: DataFrame, name: str, key: str = "doc_id", quality: str = "quality") -> DataFrame:
    """Rows with the struct ``statistics`` in column ``name`` get ``base_failed``, ``rule`` and ``kept`` in that struct.

    The rows are staged once, so texts are read once. Only labelled rows that pass the base rules teach. They meet their
    labels by shuffle: by the size of their files either side may look small, and a broadcast of it passes the driver.
    """
    rows = staged(rows, "op2-statistics").withColumn(name, flat(F.col(name)))
    s = F.col(name)
    known = labels.filter(F.col(quality).isNotNull()).groupBy(F.col(key).alias("label_key")).agg(F.min(quality).alias("label"))
    labelled = (
        rows.filter(~base_failed(s)).select(F.col(key).alias("doc_id"), features(s).alias("values"))
        .join(known.hint("merge"), F.col("doc_id") == F.col("label_key"))
        .select("doc_id", "values", (F.col("label") == 0).cast("int").alias("poor"))
    )
    rule = decision(learn(labelled), features(s))
    verdict = s.withField("base_failed", base_failed(s)).withField("rule", rule).withField("kept", ~base_failed(s) & rule.isNull())
    return rows.withColumn(name, verdict)


def kept_documents(docs: DataFrame, labels: DataFrame, text: str = "text") -> DataFrame:
    """The rows of ``docs`` that neither fail the base rules nor meet a learned rule."""
    name = free_name(docs, "judged")
    rows = judged_statistics(docs.withColumn(name, statistics(F.col(text))), labels, name)
    return rows.filter(F.col(name)["kept"]).drop(name)

"""Quality rules: text statistics as expressions, and a decision list learned from labelled statistics."""

from __future__ import annotations

import math
from dataclasses import dataclass, field
from itertools import pairwise

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegrid.llm.common import WORD, checkpoint, let, pick, small_side

#: Words of a window whose repetition counts.
WINDOW = 8
#: Labelled ids are broadcast up to so many (8 bytes each), and shuffled beyond.
BROADCAST_LABELS = 1_000_000
SYMBOLS = "#*$%&|<>"
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_distinct_words", "n_lines", "n_upper", "n_marks", "n_digits")


def _repeated_words(h: Column) -> Column:
    """Words inside windows that occur twice or more, from the hashes of all words in order."""
    windows = F.transform(F.sequence(F.lit(0), F.size(h) - WINDOW), lambda i: F.xxhash64(F.slice(h, i + 1, WINDOW)))

    def covered(starts: Column) -> Column:
        gaps = F.transform(starts, lambda p, k: F.least(F.coalesce(F.get(starts, k + 1) - p, F.lit(WINDOW)), F.lit(WINDOW)))
        return F.aggregate(gaps, F.lit(0), lambda a, g: a + g)

    def twins(ordered: Column) -> Column:
        same = lambda x, k: F.coalesce(F.get(ordered, k)["hash"] == x["hash"], F.lit(False))
        kept = F.transform(ordered, lambda x, k: F.when(same(x, k - 1) | same(x, k + 1), x["at"]))
        return let(F.array_sort(F.filter(kept, lambda p: p.isNotNull())), covered)

    def count(w: Column) -> Column:
        ordered = F.array_sort(F.transform(w, lambda x, i: F.struct(x.alias("hash"), i.alias("at"))))
        return F.when(F.size(F.array_distinct(w)) == F.size(w), F.lit(0)).otherwise(let(ordered, twins))

    return F.when(F.size(h) < WINDOW + 1, F.lit(0)).otherwise(let(windows, count)).cast("long")


def text_statistics(text: Column) -> Column:
    """struct of ``COUNTS`` (all long) of a whole text; null counts as empty.

    A word is a run of characters other than ASCII white space; ``word_chars`` are code points in words;
    ``n_dup_lines`` are lines with a word that equal an earlier line; ``n_repeat_words`` are the words in
    windows of eight words found twice or more in the text, the first occurrence included (windows are
    compared by 64-bit hashes).
    """

    def of(t: Column) -> Column:
        hashes = F.transform(F.regexp_extract_all(t, F.lit(WORD), F.lit(0)), lambda w: F.xxhash64(w))
        lines = F.filter(F.split(t, "\n"), lambda x: x.rlike(WORD))
        by_words = let(
            hashes,
            lambda h: F.struct(F.size(h).cast("long").alias("n"), F.size(F.array_distinct(h)).cast("long").alias("d"), _repeated_words(h).alias("r")),
        )
        by_lines = let(lines, lambda x: F.struct(F.size(x).cast("long").alias("n"), (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("d")))
        dense = F.regexp_replace(t, "[\\x20\\x09-\\x0D]+", "")
        by_chars = let(
            dense,
            lambda x: F.struct(
                F.length(x).cast("long").alias("n"), (F.length(x) - F.length(F.regexp_replace(x, "[#*$%&|<>]+", ""))).cast("long").alias("s"),
                (F.length(x) - F.length(F.regexp_replace(x, "\\p{Lu}+", ""))).cast("long").alias("u"),
                (F.length(x) - F.length(F.regexp_replace(x, "[!?]+", ""))).cast("long").alias("m"),
                (F.length(x) - F.length(F.regexp_replace(x, "[0-9]+", ""))).cast("long").alias("g"),
            ),
        )
        return let(
            F.struct(by_words.alias("w"), by_lines.alias("l"), by_chars.alias("c")),
            lambda s: F.struct(
                s["w"]["n"].alias("n_words"), s["c"]["n"].alias("word_chars"), s["c"]["s"].alias("n_symbols"), s["l"]["d"].alias("n_dup_lines"),
                s["w"]["r"].alias("n_repeat_words"), s["w"]["d"].alias("n_distinct_words"), s["l"]["n"].alias("n_lines"), s["c"]["u"].alias("n_upper"),
                s["c"]["m"].alias("n_marks"), s["c"]["g"].alias("n_digits"),
            ),
        )

    return let(F.coalesce(text, F.lit("")), of)


def base_failed(s: Column) -> Column:
    return (s["n_words"] < 20) | (F.lit(100) * s["n_repeat_words"] > F.lit(30) * s["n_words"])


def features(s: Column) -> dict[str, Column]:
    """What conditions may test: ratios that don't depend on a text's length (0 for an empty text)."""

    def ratio(over: str, under: str) -> Column:
        return F.when(s[under] > 0, s[over].cast("double") / s[under]).otherwise(F.lit(0.0))

    return {
        "symbols_per_char": ratio("n_symbols", "word_chars"), "upper_per_char": ratio("n_upper", "word_chars"), "marks_per_word": ratio("n_marks", "n_words"),
        "digits_per_char": ratio("n_digits", "word_chars"), "dup_lines_per_line": ratio("n_dup_lines", "n_lines"),
        "repeats_per_word": ratio("n_repeat_words", "n_words"), "distinct_per_word": ratio("n_distinct_words", "n_words"),
        "chars_per_word": ratio("word_chars", "n_words"), "words_per_line": ratio("n_words", "n_lines"),
    }


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool
    cut: float

    def column(self, values: dict[str, Column]) -> Column:
        v = values[self.feature]
        return v > F.lit(self.cut) if self.above else v <= F.lit(self.cut)

    def __str__(self) -> str:
        return f"{self.feature} {'>' if self.above else '<='} {self.cut:.6g}"


@dataclass
class DecisionList:
    """Ordered rules, each a conjunction that rejects; a text that no rule takes is kept."""

    rules: list[list[Condition]] = field(default_factory=list)

    def keeps(self, s: Column) -> Column:
        """The list as one ordered conditional expression over a struct of statistics."""
        values, verdict = features(s), None
        for rule in self.rules:
            met = F.lit(True)
            for c in rule:
                met = met & c.column(values)
            verdict = F.when(met, F.lit(False)) if verdict is None else verdict.when(met, F.lit(False))
        return F.lit(True) if verdict is None else verdict.otherwise(F.lit(True))

    def __str__(self) -> str:
        return "\n".join("reject if " + " and ".join(map(str, r)) for r in self.rules) + "\nelse keep"


def _gain(p0: float, n0: float, p: float, n: float) -> float:
    return p * (math.log2((p + 1) / (p + n + 1)) - math.log2((p0 + 1) / (p0 + n0 + 1))) if p else -1.0


def _covering_cuts(rows: DataFrame, names: list[str], n_cuts: int) -> dict[str, list[float]]:
    """Cuts half way between neighbouring quantiles that the good and the bad rows have, each class for itself, so a kind that is
    rare among all rows still has cuts of its own."""
    share = [i / n_cuts for i in range(n_cuts + 1)]
    sketches = [F.percentile_approx(F.when(F.col("bad") == bad, F.col(n)), share, 10_000).alias(f"{n}_{bad}") for n in names for bad in (True, False)]
    found = rows.agg(*sketches).first()
    points = {n: sorted({*(found[f"{n}_True"] or []), *(found[f"{n}_False"] or [])}) for n in names}
    return {n: [(a + b) / 2 for a, b in pairwise(p)] for n, p in points.items()}


def _covered(rows: DataFrame, cuts: dict[str, list[float]]) -> dict[tuple[int, str, int], tuple[int, int]]:
    """(bad, good) rows by fold, feature and bin, in one aggregate."""

    def bin_of(name: str) -> Column:
        value = F.col(name)
        return F.size(F.filter(F.array(*map(F.lit, cuts[name])), lambda cut: cut < value)) if cuts[name] else F.lit(0)

    per = F.explode(F.array(*(F.struct(F.lit(n).alias("feature"), bin_of(n).alias("bin")) for n in cuts))).alias("x")
    table = rows.select("fold", "bad", per).groupBy("fold", "x.feature", "x.bin").agg(F.count_if("bad").alias("p"), F.count_if(~F.col("bad")).alias("n"))
    return {(r["fold"], r["feature"], r["bin"]): (r["p"], r["n"]) for r in table.collect()}


def _fold_counts(table: dict, fold: int, feature: str) -> tuple[int, int]:
    rows = [v for (f, n, _), v in table.items() if f == fold and n == feature]
    return sum(p for p, _ in rows), sum(n for _, n in rows)


def _best_condition(table: dict, cuts: dict[str, list[float]], p0: int, n0: int, least_covered: int) -> Condition | None:
    gain, top = 1e-9, None
    for name, points in cuts.items():
        p = n = 0
        for at, cut in enumerate(points):
            dp, dn = table.get((0, name, at), (0, 0))
            p, n = p + dp, n + dn
            for condition, a, b in ((Condition(name, False, cut), p, n), (Condition(name, True, cut), p0 - p, n0 - n)):
                if a >= least_covered and b < n0 and (g := _gain(p0, n0, a, b)) > gain:
                    gain, top = g, condition
    return top


def learn_decision_list(
    statistics: DataFrame, labels: DataFrame, n_cuts: int = 63, least_precision: float = 0.95, least_covered: int = 3,
) -> DecisionList:
    """Sequential covering over all labelled rows: grow a rule for quality 0 condition by condition on
    two thirds of them, prune it on the rest, accept it if it is precise, drop what it covers, repeat.

    ``statistics`` has doc_id and stats, ``labels`` doc_id and quality. A step is two aggregates over the rows that the
    rule still covers: quantiles of each feature in each class give the cuts, so they get finer around what was chosen before,
    and counts by (fold, feature, bin) the gains; at most 2 x 9 x 2 (n_cuts + 1) rows come back whatever the input. A rule grows
    until it covers no good row or nothing helps. A rule that isn't precise on the held-out rows is not learned, and the bad rows
    that it covers are set aside, so covering goes on until no rule covers ``least_covered`` bad rows: the
    number of rules and of conditions isn't limited. Folds come from a hash of doc_id. Documents with
    contradicting labels are left out, as are texts that the base rules reject anyway. Without labels,
    or with one class only, the list is empty and keeps everything. Repeated rows count as often as they are there.
    """
    known = (
        pick(labels, "doc_id", "quality").where(F.col("quality").isNotNull())
        .groupBy("doc_id").agg(F.min("quality").alias("q"), F.max("quality").alias("most")).where(F.col("q") == F.col("most"))
    )
    names = list(features(F.col("stats")))
    rows = statistics.where(~base_failed(F.col("stats"))).join(known, "doc_id")
    values = rows.select(
        F.when(F.pmod(F.xxhash64("doc_id"), F.lit(3)) == 0, F.lit(1)).otherwise(F.lit(0)).alias("fold"), (F.col("q") == 0).alias("bad"),
        *(v.alias(n) for n, v in features(F.col("stats")).items()),
    )
    left, learned = checkpoint(values), DecisionList()
    while True:
        rule: list[Condition] = []
        covered = left
        held_out: list[tuple[int, int]] = []  # what each prefix of the rule covers in the pruning fold
        while True:
            cuts = _covering_cuts(covered, names, n_cuts)
            table = _covered(covered, cuts)
            p0, n0 = _fold_counts(table, 0, names[0])
            held_out.append(_fold_counts(table, 1, names[0]))
            condition = _best_condition(table, cuts, p0, n0, least_covered) if p0 and n0 else None
            if condition is None:
                break
            rule = [*rule, condition]
            covered = covered.where(condition.column({n: F.col(n) for n in names}))
        if not rule:
            return learned
        worth = [(p - n) / (p + n) if p + n else -1.0 for p, n in held_out[1:]]
        keep = max(range(len(worth)), key=lambda i: (worth[i], -i))
        p, n = held_out[keep + 1]
        precise = p > 0 and p >= least_precision * (p + n)
        rule = rule[: keep + 1] if precise else rule
        met = F.lit(True)
        for c in rule:
            met = met & c.column({n: F.col(n) for n in names})
        if precise:
            learned.rules.append(rule)
        left = checkpoint(left.where(~met if precise else ~met | ~F.col("bad")))


def with_statistics(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, stats), written once."""
    return checkpoint(pick(docs, key, text).toDF("doc_id", "text").select("doc_id", text_statistics(F.col("text")).alias("stats")))


def judge(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Per row: doc_id, the counts, base_failed and kept. A null or empty text has zero counts and fails
    the base rules; repeated rows get equal verdicts; other columns don't matter."""
    rows = with_statistics(docs)
    model = learn_decision_list(rows, labels)
    s = F.col("stats")
    return rows.select(
        "doc_id", *(s[c].alias(c) for c in COUNTS), base_failed(s).alias("base_failed"), (~base_failed(s) & model.keeps(s)).alias("kept")
    )


def keep_clean(docs: DataFrame, labels: DataFrame, text: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns, that base rules and decision list keep. The list is learned first, from
    the labelled rows alone; the statistics are then part of the filter, so no text is shuffled unless the labels are too
    many to broadcast. Null and empty texts fail the base rules; rows without an id are judged like all others; repeated rows fare alike; an
    empty table gives no rows."""
    names = [f"c{i}" for i in range(len(docs.columns))]
    listed = small_side(checkpoint(pick(labels, "doc_id").where("doc_id is not null").distinct()), BROADCAST_LABELS)
    model = learn_decision_list(with_statistics(pick(docs, "doc_id", text).toDF("doc_id", "text").join(listed, "doc_id", "left_semi")), labels)
    body = F.col(names[docs.columns.index(text)])
    verdict = let(text_statistics(body), lambda s: ~base_failed(s) & model.keeps(s))
    return docs.toDF(*names).where(verdict).toDF(*docs.columns)

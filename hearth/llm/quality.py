"""Quality rules by weak supervision, in DataFrame functions only.

Each rule votes good (1), bad (-1) or abstains (0) on a document.  Documents
with the same votes are one row of a vote table of at most 3**rules rows, a
partial aggregate over all documents.  Expectation-maximisation on that table
estimates how often each rule is right on good and on bad documents and the
share of good ones; the posterior probability that a document is good, from all
its votes together, replaces "passes every rule".

Nothing here runs Python on the executors.  A document's word windows are
handled as arrays of 64-bit hashes inside its own row, so no shuffle carries
text; the only shuffle is the vote table.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hearth.llm.tables import saved

#: word separators: \x20 and \x09-\x0D
_WS = "[\\x20\\x09-\\x0D]+"
REPEAT_WINDOW = 8
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30


def _words(text: Column) -> Column:
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(" \t\n\x0b\x0c\r"))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, _WS))


def _repeat_words(words: Column, n_words: Column, window: int) -> Column:
    """Words inside windows of ``window`` words that occur twice or more in the
    text, the first included.  Windows are compared by 64-bit hash; texts
    without a repeated window (the common case) stop after ``array_distinct``."""
    hashes = F.transform(F.sequence(F.lit(1), n_words - window + 1), lambda i: F.xxhash64(F.slice(words, i, window)))
    # One-element arrays bind a name, so an array is built once, not per element.
    bind = lambda value, body: F.element_at(F.transform(F.array(value), body), 1)

    def covered(h: Column) -> Column:
        pairs = F.array_sort(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))

        def repeated(p: Column) -> Column:
            n = F.size(p)
            same = lambda a, b: F.element_at(p, a).h == F.element_at(p, b).h
            hit = F.filter(
                p, lambda _, k: ((k > 0) & same(F.greatest(k, F.lit(1)), k + 1)) | ((k < n - 1) & same(k + 1, F.least(k + 2, n)))
            )
            return F.array_sort(F.transform(hit, lambda x: x.i))

        def total(at: Column) -> Column:
            return F.aggregate(
                at, F.struct(F.lit(0).alias("n"), F.lit(0).alias("e")),
                lambda s, i: F.struct((s.n + (i + window - F.greatest(s.e, i))).alias("n"), (i + window).alias("e")),
                lambda s: s.n,
            )

        return bind(bind(pairs, repeated), total)

    counted = bind(hashes, lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(covered(h)))
    return F.when(n_words < window, F.lit(0)).otherwise(counted).cast("long")


def measures(df: DataFrame, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``df`` plus the measures the rules use, over the whole text: n_words,
    word_chars (code points in words), n_symbols (``#*$%&|<>``), n_dup_lines
    (lines with a word that equal an earlier line), n_repeat_words (in repeated
    8-word windows), and n_lines, n_distinct, n_upper, n_marks for the
    votes.  Null and empty texts: all 0.  ``keep``: the columns of ``df`` that
    are passed on (all, if not given); columns of these names are replaced."""
    keep = df.columns if keep is None else keep
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    base = df.select(*[F.col(f"`{c}`") for c in keep if c not in _MEASURES], text.alias("__t")).withColumn("__w", _words(F.col("__t")))
    w, t = F.col("__w"), F.col("__t")
    lines = F.filter(F.split(t, "\n"), lambda x: F.btrim(x, F.lit(" \t\n\x0b\x0c\r")) != "")
    base = base.withColumn("__l", lines).withColumn("n_words", F.size(w).cast("long"))
    count = {
        "word_chars": F.length(F.array_join(w, "")),
        "n_symbols": F.regexp_count(t, F.lit("[#*$%&|<>]")),
        "n_dup_lines": F.size("__l") - F.size(F.array_distinct("__l")),
        "n_repeat_words": _repeat_words(w, F.col("n_words").cast("int"), REPEAT_WINDOW),
        "n_lines": F.size("__l"),
        "n_distinct": F.size(F.array_distinct(w)),
        "n_upper": F.regexp_count(t, F.lit("[A-ZÀ-Þ]")),
        "n_marks": F.regexp_count(t, F.lit("[!?]")),
    }
    return base.select(
        *[c for c in base.columns if c not in ("__t", "__w", "__l")], *[v.cast("long").alias(k) for k, v in count.items()]
    )


_MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_distinct", "n_upper", "n_marks")


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))


def _vote(value: Column, good: Column, bad: Column) -> Column:
    return F.when(value.isNull(), 0).when(bad, -1).when(good, 1).otherwise(0).cast("int")


def votes() -> dict[str, Column]:
    """The rules, on the columns of ``measures``.  Between the bounds a rule
    abstains; ratios of empty texts are null and abstain too."""
    n, ratio = F.col("n_words"), lambda a, b: F.when(F.col(b) > 0, F.col(a) / F.col(b))
    word_len, symbols = ratio("word_chars", "n_words"), ratio("n_symbols", "n_words")
    repeat, dup = ratio("n_repeat_words", "n_words"), ratio("n_dup_lines", "n_lines")
    upper, marks, variety = ratio("n_upper", "word_chars"), ratio("n_marks", "n_words"), ratio("n_distinct", "n_words")
    return {
        "length": _vote(n, n >= 50, n < 20),
        "word_length": _vote(word_len, word_len.between(3.5, 8.0), (word_len < 2.5) | (word_len > 12)),
        "symbols": _vote(symbols, symbols < 0.02, symbols > 0.1),
        "repeats": _vote(repeat, repeat < 0.05, repeat > 0.3),
        "dup_lines": _vote(dup, dup < 0.1, dup > 0.3),
        "upper": _vote(upper, upper < 0.1, upper > 0.4),
        "marks": _vote(marks, marks < 0.05, marks > 0.3),
        "variety": _vote(variety, (n >= 50) & (variety > 0.25), (n >= 50) & (variety < 0.12)),
    }


@dataclass(frozen=True)
class VoteModel:
    """Share of good documents; per rule the chances of (good, bad) votes on
    good and on bad documents."""

    prior: float
    on_good: dict[str, tuple[float, float]]
    on_bad: dict[str, tuple[float, float]]

    def posterior(self) -> Column:
        """Probability that a document is good, on the vote columns."""
        odds = F.lit(math.log(self.prior / (1 - self.prior)))
        for name in self.on_good:
            v = F.col(name)
            up, down = (math.log(self.on_good[name][i] / self.on_bad[name][i]) for i in (0, 1))
            odds = odds + F.when(v == 1, up).when(v == -1, down).otherwise(0.0)
        return 1 / (1 + F.exp(-odds))


def _model(names: list[str], prior: float, right: float) -> VoteModel:
    return VoteModel(prior, {n: (right, 1 - right) for n in names}, {n: (1 - right, right) for n in names})


def fit(table: DataFrame, names: list[str], rounds: int = 100, tolerance: float = 1e-6) -> VoteModel:
    """Expectation-maximisation on a vote table (the vote columns and ``n``).

    Each round is one aggregate that returns one row of sums.  Abstaining says
    nothing.  Chances carry a prior of 20 pseudo-votes at the starting accuracy
    of 0.8, so a rule that never votes keeps it and labels cannot swap; an empty
    table gives the starting model."""
    model = _model(names, 0.8, 0.8)
    for _ in range(rounds):
        g, n = F.col("__g"), F.col("n")
        sums = [F.sum(n * g).alias("good"), F.sum(n).alias("all")]
        for i, c in enumerate(names):
            for side, weight in (("g", g), ("b", 1 - g)):
                sums += [
                    F.sum(F.when(F.col(c) == vote, n * weight).otherwise(0.0)).alias(f"{side}{i}{kind}")
                    for vote, kind in ((1, "u"), (-1, "d"))
                ]
        r = table.withColumn("__g", model.posterior()).agg(*sums).first()
        total = r["all"] or 0
        share = lambda up, down, right: (up + 20 * right) / (up + down + 20)
        good, bad = {}, {}
        for i, c in enumerate(names):
            p = share(r[f"g{i}u"] or 0, r[f"g{i}d"] or 0, 0.8)
            q = share(r[f"b{i}d"] or 0, r[f"b{i}u"] or 0, 0.8)
            p, q = max(p, 0.5), max(q, 0.5)  # a rule is at least as good as chance
            good[c], bad[c] = (p, 1 - p), (1 - q, q)
        new = VoteModel(((r["good"] or 0) + 16) / (total + 20), good, bad)
        moved = max(
            [abs(new.prior - model.prior)]
            + [abs(a - b) for c in names for x, y in ((new.on_good, model.on_good), (new.on_bad, model.on_bad)) for a, b in zip(x[c], y[c], strict=True)]
        )
        model = new
        if moved < tolerance:
            break
    return model


def judge(df: DataFrame, text_col: str = "text", keep: list[str] | None = None, save=saved) -> DataFrame:
    """``measures`` plus the votes, ``p_good``, ``base_failed`` and ``kept``
    (p_good >= 0.5 and not base_failed).  The model is fitted on all rows of
    ``df``.  ``save`` writes the measured rows once and returns them: a filter
    pushed below the measures would repeat their expressions."""
    rules = votes()
    m = measures(df, text_col, keep)
    m = save(m.select("*", *[v.alias(f"vote_{k}") for k, v in rules.items()]))
    names = [f"vote_{k}" for k in rules]
    model = fit(save(m.groupBy(*names).agg(F.count("*").alias("n"))), names)
    return m.withColumn("p_good", model.posterior()).withColumn("base_failed", base_failed()).withColumn(
        "kept", (F.col("p_good") >= 0.5) & ~F.col("base_failed")
    )


def keep_good(docs: DataFrame, key: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without the documents that ``judge`` rejects, same columns.
    Rows are named by a hash of id and text; the rejected ones, which are few,
    are anti-joined."""
    rows = docs.withColumn("__row", F.xxhash64(F.col(f"`{key}`"), F.col(f"`{text_col}`")))
    slim = rows.select("__row", F.col(f"`{text_col}`").alias("__text"))
    bad = saved(judge(slim, "__text", ["__row"]).where("not kept").select("__row").distinct())
    return rows.join(bad, "__row", "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])

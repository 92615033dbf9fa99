"""Operator 5 [native]: weakly supervised quality rules.

Each rule votes a document good (1) or bad (-1) or abstains (0). Nothing is labelled:
a document is good or has one of several kinds of fault, one kind led by each rule, and
expectation-maximisation finds from how the rules agree over all documents how common
each class is and how often each rule votes bad on it. The verdict is the posterior
probability of good, in place of having to pass every rule.

Documents come into the estimation as counts of equal vote patterns, at most 3 to the
number of rules whatever the input, added up before the shuffle. The iterations are one
fold over a fixed number of steps on that one row. Everything is column functions.

Cases: null and empty texts have no words, fail the base rules and vote bad on length
only; repeated documents count and are judged each; an empty table leaves the starting
values; other columns pass in `kept`, whatever their names, and in the steps before it
unless they have the name of a feature, which replaces them.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import partial
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, functions as F

from .common import SPACE_CLASS, sheltered, worked_out

WINDOW = 8
STEPS = 30
# Starting values and the ranges the estimates stay in.
GOOD = 0.85
ON_GOOD, ON_GOOD_RANGE = 0.01, (0.0005, 0.02)  # bad votes on good documents
ON_OWN, ON_OWN_RANGE = 0.9, (0.6, 0.99)  # of the rule that leads a kind of fault
ON_OTHER, ON_OTHER_RANGE = 0.2, (0.01, 0.9)  # of the other rules
LEAST_SHARE = 0.001  # of a class

FEATURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_marks")


class Model(NamedTuple):
    """The estimates: the share of each class, good first and then a kind of fault per
    rule; and for each class the chance of a bad vote of each rule, given that it votes."""

    share: tuple[float, ...]
    bad: tuple[tuple[float, ...], ...]


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """`use(value)` with the value worked out once, however often it is used."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _repeated(words: Column) -> Column:
    """How many words stand in windows that the text holds twice or more.

    Hashes find the texts without any such window; only the others compare words.
    """
    n = F.size(words)
    starts = F.sequence(F.lit(1), n - (WINDOW - 1))

    def exact() -> Column:
        keyed = F.sort_array(F.transform(starts, lambda i: F.struct(F.array_join(F.slice(words, i, WINDOW), " ").alias("k"), i.alias("i"))))

        def covered(s: Column) -> Column:
            key = lambda j: F.get(s, j)["k"]
            twice = F.filter(s, lambda e, j: F.coalesce(key(j + 1) == e["k"], F.lit(False)) | F.coalesce((j > 0) & (key(j - 1) == e["k"]), F.lit(False)))
            places = F.sort_array(F.transform(twice, lambda e: e["i"]))
            start = F.struct(F.lit(0).alias("end"), F.lit(0).alias("n"))
            step = lambda a, i: F.struct((i + WINDOW).alias("end"), (a["n"] + WINDOW - F.greatest(F.lit(0), a["end"] - i)).alias("n"))
            return F.aggregate(places, start, step, lambda a: a["n"])

        return _let(keyed, covered)

    # Hashes of runs of 1, 2, 4 and 8 words, each from two of half the length; runs over
    # the end are hashed too and cut off.
    hashes, length = F.transform(words, lambda w: F.xxhash64(w)), 1
    while length < WINDOW:
        hashes, length = _let(hashes, partial(_doubled, length)), 2 * length
    windows = F.slice(hashes, F.lit(1), n - (WINDOW - 1))
    distinct = F.size(F.array_distinct(windows)) == n - (WINDOW - 1)
    return F.when(n <= WINDOW, 0).otherwise(F.when(distinct, 0).otherwise(exact())).cast("bigint")


def _doubled(length: int, hashes: Column) -> Column:
    return F.transform(hashes, lambda h, i: F.xxhash64(h, F.get(hashes, i + length)))


def features(docs: DataFrame) -> DataFrame:
    """The documents with the counts that the rules look at (`FEATURES`)."""
    text = F.coalesce(F.col("text"), F.lit(""))
    # What the three character counts look at is picked out once; it is short.
    marked = F.regexp_replace(text, r"[^A-Z!?#*$%&|<>]+", "")
    left = lambda drop: F.length(F.regexp_replace("_marked", drop, "")).cast("bigint")
    words = F.array_remove(F.split(text, f"{SPACE_CLASS}+"), "")
    of_words = _let(
        words,
        lambda w: F.struct(
            F.size(w).cast("bigint").alias("n"),
            F.length(F.array_join(w, "")).cast("bigint").alias("chars"),
            _repeated(w).alias("repeated"),
        ),
    )
    with_word = F.filter(F.split(text, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    of_lines = _let(with_word, lambda s: F.struct(F.size(s).cast("bigint").alias("n"), F.size(F.array_distinct(s)).cast("bigint").alias("kinds")))
    docs = worked_out(docs.drop(*FEATURES), {"_words": of_words, "_lines": of_lines, "_marked": marked})
    made = {
        "n_words": F.col("_words.n"),
        "word_chars": F.col("_words.chars"),
        "n_symbols": left(r"[^#*$%&|<>]+"),
        "n_dup_lines": F.col("_lines.n") - F.col("_lines.kinds"),
        "n_repeat_words": F.col("_words.repeated"),
        "n_lines": F.col("_lines.n"),
        "n_upper": left(r"[^A-Z]+"),
        "n_marks": left(r"[^!?]+"),
    }
    return worked_out(docs, made).drop("_words", "_lines", "_marked")


def _votes() -> dict[str, Column]:
    """The rules. The limits are well apart from what ordinary prose shows; between the
    two of a rule it abstains."""
    n, c = F.col("n_words"), F.col("word_chars")

    def rule(bad: Column, good: Column) -> Column:
        return F.when(n == 0, 0).when(bad, -1).when(good, 1).otherwise(0)

    return {
        "length": F.when(n < 20, -1).when(n >= 50, 1).otherwise(0),
        "word_length": rule((c < 3 * n) | (c > 12 * n), (c >= 4 * n) & (c <= 9 * n)),
        "symbols": rule(F.col("n_symbols") * 10 > n * 3, F.col("n_symbols") * 20 <= n),
        "upper_case": rule(F.col("n_upper") * 10 > c * 4, F.col("n_upper") * 10 <= c * 2),
        "marks": rule(F.col("n_marks") * 10 > n * 3, F.col("n_marks") * 20 <= n),
        "dup_lines": rule(
            (F.col("n_dup_lines") * 10 > F.col("n_lines") * 3) & (F.col("n_dup_lines") > 1), F.col("n_dup_lines") * 10 <= F.col("n_lines")
        ),
        "repeats": rule(F.col("n_repeat_words") * 100 > n * 30, F.col("n_repeat_words") * 100 <= n * 10),
    }


RULES = ("length", "word_length", "symbols", "upper_case", "marks", "dup_lines", "repeats")


def votes(counted: DataFrame) -> DataFrame:
    """Adds `votes`, the rules' votes in the order of RULES."""
    made = _votes()
    return worked_out(counted.drop("votes"), {"votes": F.array(*[made[name] for name in RULES])})


def _starting() -> Model:
    rules = range(len(RULES))
    share = (GOOD, *[(1 - GOOD) / len(RULES) for _ in rules])
    faults = [tuple(ON_OWN if i == j else ON_OTHER for j in rules) for i in rules]
    return Model(share, (tuple(ON_GOOD for _ in rules), *faults))


def _classes(of_votes: Column, share: Column, bad: Column) -> Column:
    """The posterior probabilities of the classes, given the votes."""

    def chance(k: Column) -> Column:
        def vote(a: Column, j: Column) -> Column:
            of_bad = F.get(F.get(bad, k), j)
            v = F.get(of_votes, j)
            return a * F.when(v == -1, of_bad).when(v == 1, 1 - of_bad).otherwise(1.0)

        return F.aggregate(F.sequence(F.lit(0), F.lit(len(RULES) - 1)), F.get(share, k), vote)

    all_classes = F.transform(F.sequence(F.lit(0), F.lit(len(RULES))), chance)
    total = lambda c: F.aggregate(c, F.lit(0.0), lambda a, x: a + x)
    return _let(all_classes, lambda c: _let(total(c), lambda t: F.transform(c, lambda x: x / t)))


def fit(voted: DataFrame, steps: int = STEPS) -> Model:
    """The estimates from the votes of all documents. Runs a job; one row comes back."""
    patterns = voted.groupBy("votes").agg(F.count("*").alias("n"))
    one = patterns.agg(F.sort_array(F.collect_list(F.struct("votes", "n"))).alias("patterns"))
    start = _starting()
    n_rules = len(RULES)

    def step(p: Column, _: Column) -> Column:
        weighted = F.transform(
            "patterns",
            lambda x: F.struct(x["votes"].alias("v"), F.transform(_classes(x["votes"], p["share"], p["bad"]), lambda c: c * x["n"]).alias("w")),
        )

        def maximise(w: Column) -> Column:
            def total(k: int, of: Callable[[Column], Column] | None = None) -> Column:
                one = lambda x: F.get(x["w"], F.lit(k))
                add = lambda a, x: a + (one(x) if of is None else F.when(of(x["v"]), one(x)).otherwise(0.0))
                return F.aggregate(w, F.lit(0.0), add)

            def rate(k: int, j: int) -> Column:
                kept_in = ON_GOOD_RANGE if k == 0 else ON_OWN_RANGE if k == j + 1 else ON_OTHER_RANGE
                found = F.try_divide(total(k, lambda v: F.get(v, F.lit(j)) == -1), total(k, lambda v: F.get(v, F.lit(j)) != 0))
                return F.least(F.greatest(F.coalesce(found, F.lit(start.bad[k][j])), F.lit(kept_in[0])), F.lit(kept_in[1]))

            sums = F.array(*[total(k) for k in range(n_rules + 1)])
            n = F.aggregate(sums, F.lit(0.0), lambda a, x: a + x)
            share = F.when(n > 0, F.transform(sums, lambda x: F.greatest(x / n, F.lit(LEAST_SHARE)))).otherwise(_literal(start.share))
            return F.struct(
                share.alias("share"),
                F.array(*[F.array(*[rate(k, j) for j in range(n_rules)]) for k in range(n_rules + 1)]).alias("bad"),
            )

        return _let(weighted, maximise)

    begin = F.struct(_literal(start.share).alias("share"), F.array(*[_literal(row) for row in start.bad]).alias("bad"))
    found = one.select(F.aggregate(F.sequence(F.lit(1), F.lit(steps)), begin, step).alias("p")).first()["p"]
    return Model(tuple(found["share"]), tuple(tuple(row) for row in found["bad"]))


def _literal(numbers: tuple[float, ...]) -> Column:
    return F.array(*[F.lit(x) for x in numbers])


def judged(voted: DataFrame, model: Model, least: float = 0.5) -> DataFrame:
    """Adds `base_failed`, `probability` and `kept`."""
    classes = _classes(F.col("votes"), _literal(model.share), F.array(*[_literal(row) for row in model.bad]))
    base_failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    return (
        voted.withColumn("base_failed", base_failed)
        .withColumn("probability", F.get(classes, F.lit(0)))
        .withColumn("kept", ~F.col("base_failed") & (F.col("probability") >= least))
    )


def kept(docs: DataFrame) -> DataFrame:
    """The documents whose verdict is good, with the columns given. Two narrow passes,
    one for the estimates and one to judge; nothing is shuffled but pattern counts."""
    docs, restored = sheltered(docs, "text")
    voted = votes(features(docs))
    return restored(judged(voted, fit(voted.select("votes"))).where("kept"))

"""Quality rules whose cutoffs come from labelled documents, with a limit on false rejections.

Each rule rejects a document whose measure exceeds a cutoff.  Cutoffs are tried from
lenient to strict on a fixed ladder.  In every stratum the good labelled documents are a
holdout: a cutoff is admitted if an exact binomial test shows that it rejects at most a
stated share of good documents.  The chance that any guarantee fails is limited over all
rules and strata together: the error is divided among them (Bonferroni), and within one
rule the ladder is tested in fixed order until the first failure, which costs nothing.
The share is divided among the rules, so it holds for all rules of a stratum together.

A stratum with too few labels to prove anything keeps everything that the base rules keep.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loanlens.llm.text import BLANK_CLASS, WORD_CLASS, words
from loanlens.session import materialised

WINDOW = 5
# Base rules and the symbols that they count.
LEAST_WORDS = 10
MOST_REPEATED_PCT = 20
NOT_SYMBOL = "[^#*$%&|<>]+"

# Ladder of each rule, lenient to strict; chosen once, not from the labels.
LADDERS: dict[str, tuple[float, ...]] = {
    "symbols": (2.0, 1.5, 1.0, 0.7, 0.5, 0.3, 0.2, 0.1, 0.05),
    "capitals": (0.8, 0.6, 0.5, 0.4, 0.3, 0.25, 0.2, 0.15),
    "repeats": (0.9, 0.7, 0.5, 0.4, 0.3, 0.2),
    "same_lines": (0.9, 0.7, 0.5, 0.3, 0.2, 0.1),
}
# Strata are a fixed list and the rest, so the table of cutoffs has a fixed size.
STRATA = ("en", "de", "fr", "es")
MOST_FALSE = 0.05
ERROR = 0.05

BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _repeated_exactly(w: Column) -> Column:
    """Words in windows that occur twice or more, by sorting the windows with their places."""
    last = F.size(w) - WINDOW
    grams = F.transform(
        F.sequence(F.lit(0), last), lambda i: F.struct(F.array_join(F.slice(w, i + 1, WINDOW), " ").alias("g"), i.alias("i"))
    )

    def twins(s: Column) -> Column:
        def place(e: Column, j: Column) -> Column:
            same = lambda k: F.coalesce(F.get(s, k)["g"] == e["g"], F.lit(False))
            return F.when(same(j - 1) | same(j + 1), e["i"])

        return F.array_sort(F.filter(F.transform(s, place), lambda p: p.isNotNull()))

    start = F.struct(F.lit(-WINDOW).alias("at"), F.lit(0).cast("long").alias("sum"))
    return F.aggregate(
        _let(F.array_sort(grams), twins),
        start,
        lambda a, p: F.struct(p.alias("at"), (a["sum"] + F.least(F.lit(WINDOW), p - a["at"])).alias("sum")),
        lambda a: a["sum"],
    )


def _repeated(w: Column) -> Column:
    """Words that lie in a window of five found twice or more in the text.

    Most texts repeat nothing: if all windows have different hashes, that is proven.
    """
    hashes = F.transform(w, lambda x, i: F.xxhash64(x, *[F.get(w, i + k) for k in range(1, WINDOW)]))
    windows = F.size(w) - (WINDOW - 1)
    different = F.size(F.array_distinct(F.slice(hashes, 1, windows))) == windows
    return F.when(F.size(w) < WINDOW, 0).when(different, 0).otherwise(_repeated_exactly(w))


def measure(df: DataFrame, text: str, keep: Sequence[str]) -> DataFrame:
    """The columns ``keep`` with the base counts, base_failed and one measure for each rule."""
    base = df.select(*keep, F.coalesce(text, F.lit("")).alias("_t"), words(F.col(text)).alias("_w"))
    lines = F.filter(F.split("_t", "\n"), lambda x: x.rlike(WORD_CLASS))
    counted = base.select(
        *keep,
        F.size("_w").cast("long").alias("n_words"),
        F.length(F.regexp_replace("_t", f"{BLANK_CLASS}+", "")).cast("long").alias("word_chars"),
        F.length(F.regexp_replace("_t", NOT_SYMBOL, "")).cast("long").alias("n_symbols"),
        _let(lines, lambda x: F.struct(F.size(x).alias("all"), F.size(F.array_distinct(x)).alias("own"))).alias("_l"),
        _repeated(F.col("_w")).cast("long").alias("n_repeat_words"),
        F.length(F.regexp_replace("_t", "[^\\p{Lu}]+", "")).alias("_upper"),
    )
    per_word = F.greatest("n_words", F.lit(1))
    return counted.select(
        *keep,
        "n_words", "word_chars", "n_symbols",
        (F.col("_l.all") - F.col("_l.own")).cast("long").alias("n_dup_lines"),
        "n_repeat_words",
        ((F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED_PCT * F.col("n_words"))).alias("base_failed"),
        F.struct(
            (F.col("n_symbols") / per_word).alias("symbols"),
            (F.col("_upper") / F.greatest("word_chars", F.lit(1))).alias("capitals"),
            (F.col("n_repeat_words") / per_word).alias("repeats"),
            ((F.col("_l.all") - F.col("_l.own")) / F.greatest(F.col("_l.all"), F.lit(1))).alias("same_lines"),
        ).alias("rule"),
    )


def _log_gamma(x: Column) -> Column:
    """Stirling's series seven above x; good to double precision for x >= 1."""
    z = x + 7.0
    series = (z - 0.5) * F.log(z) - z + 0.5 * math.log(2 * math.pi) + 1 / (12 * z) - 1 / (360 * z**3) + 1 / (1260 * z**5)
    for k in range(7):
        series = series - F.log(x + float(k))
    return series


def most_rejected(n: Column, share: float, error: float) -> Column:
    """The largest k with P(X <= k) <= error for X ~ Binomial(n, share); -1 if there is none.

    If the true rate of false rejections were above ``share``, k or fewer among n would be
    seen with probability ``error`` at most.  The sum starts where what lies below is
    smaller than 1e-30.
    """
    n = n.cast("double")
    mean = n * share
    low = F.greatest(F.lit(0.0), F.floor(mean - 12 * F.sqrt(mean * (1 - share)) - 40))
    log_p = _log_gamma(n + 1) - _log_gamma(low + 1) - _log_gamma(n - low + 1) + low * math.log(share) + (n - low) * math.log1p(-share)
    start = F.struct(F.exp(log_p).alias("p"), F.lit(0.0).alias("sum"), F.lit(-1).cast("long").alias("k"))

    def step(a: Column, i: Column) -> Column:
        upto = a["sum"] + a["p"]
        return F.struct(
            (a["p"] * (n - i) / (i + 1) * (share / (1 - share))).alias("p"),
            upto.alias("sum"),
            F.when(upto * (1 + 1e-4) <= error, i).otherwise(a["k"]).alias("k"),
        )

    counts = F.sequence(low.cast("long"), F.greatest(low, F.floor(mean)).cast("long"))
    return F.aggregate(counts, start, step, lambda a: a["k"])


def cutoffs(measured: DataFrame, labels: DataFrame, most_false: float = MOST_FALSE, error: float = ERROR) -> DataFrame:
    """One row per stratum that has good labelled documents: the strictest admitted cutoff of each rule, null if none is.

    Labels are (doc_id, quality); a document labelled both ways counts for neither.
    """
    clear = labels.filter("doc_id IS NOT NULL").groupBy("doc_id").agg(F.min("quality").alias("q"), F.max("quality").alias("p"))
    good = clear.filter("q = 1 AND p = 1").select(F.col("doc_id").alias("_id"))
    holdout = measured.filter("NOT base_failed").join(good, F.col("doc_id") == F.col("_id"))
    steps = [(r, i, c) for r, ladder in LADDERS.items() for i, c in enumerate(ladder)]
    counts = holdout.groupBy("stratum").agg(
        F.count(F.lit(1)).alias("n"), *[F.count_if(F.col(f"rule.{r}") > c).alias(f"{r}_{i}") for r, i, c in steps]
    )
    each = error / (len(LADDERS) * (len(STRATA) + 1))
    limited = counts.withColumn("most", most_rejected(F.col("n"), most_false / len(LADDERS), each))
    chosen = []
    for r, ladder in LADDERS.items():
        # Counts grow as cutoffs get stricter, so the admitted ones are the first of the ladder.
        admitted = [F.when(F.col(f"{r}_{i}") <= F.col("most"), F.lit(c)) for i, c in enumerate(ladder)]
        chosen.append(F.least(*admitted).alias(r))
    return limited.select("stratum", F.struct(*chosen).alias("cutoff"))


def judge(measured: DataFrame, labels: DataFrame, most_false: float = MOST_FALSE, error: float = ERROR) -> DataFrame:
    """``measured`` with rejected_by (the rules that reject, comma-joined) and kept.

    ``measured`` is read twice; give it written.
    """
    limits = cutoffs(measured, labels, most_false, error)
    judged = measured.join(F.broadcast(limits), "stratum", "left")
    broken = [F.when(F.col(f"rule.{r}") > F.col(f"cutoff.{r}"), r) for r in LADDERS]
    judged = judged.withColumn("rejected_by", F.concat_ws(",", *broken))
    return judged.withColumn("kept", ~F.col("base_failed") & (F.col("rejected_by") == ""))


def _stratum() -> Column:
    return F.when(F.col("lang").isin(*STRATA), F.col("lang")).otherwise("other").alias("stratum")


def rate(docs: DataFrame, labels: DataFrame, most_false: float = MOST_FALSE, error: float = ERROR) -> DataFrame:
    """One row per document: doc_id, the base counts, base_failed, kept, rejected_by, stratum.

    Null and empty texts have no words and fail the base rules.  Unknown and null languages
    are one stratum.  Documents without an id have no label.  Repeated rows are judged
    alike; other columns are ignored.  Empty tables give an empty result; without labels
    just the base rules decide.
    """
    measured = measure(docs.select("doc_id", _stratum(), "text"), "text", ["doc_id", "stratum"])
    judged = judge(materialised(measured, "quality"), labels, most_false, error)
    return judged.select("doc_id", *BASE, "base_failed", "kept", "rejected_by", "stratum")


def keep_good(docs: DataFrame, labels: DataFrame, most_false: float = MOST_FALSE, error: float = ERROR) -> DataFrame:
    """The documents that the rules keep, all columns.  They are written once with their measures."""
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    measured = measure(docs.select("doc_id", _stratum(), "text", row), "text", ["doc_id", "stratum", "row"])
    return judge(materialised(measured, "quality-rows"), labels, most_false, error).filter("kept").select("row.*")

"""Portfolio, segment and survey metrics over the loan-by-snapshot fact."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loanlens.functions.rates import percent, ratio_where, share, tally
from loanlens.functions.risk import PAID_OFF_STATUS, RETURNED, is_write_off
from loanlens.operators.cleaning import col
from loanlens.operators.dedupe import latest_state


def book(fct: DataFrame) -> DataFrame:
    """The loans the metrics are about: everything that is not classed as returned.

    A returned loan of 90 days or more is classed as Critical and therefore stays in.
    """
    return fct.filter(F.col("risk_category") != RETURNED)


def collection_rate() -> Column:
    """Paid over due on loans not paid off; a loan without status counts on neither side."""
    return ratio_where(
        F.col("account_status_l2") != PAID_OFF_STATUS, F.col("total_paid"), F.col("total_due_today")
    )


def portfolio_kpis(fct: DataFrame) -> DataFrame:
    """Book metrics per snapshot; the shuffle carries one row per task and snapshot.

    ``active_loans`` counts all loans in the book, paid-off and written-off ones included.
    """
    return (
        book(fct)
        .groupBy("snapshot_date")
        .agg(
            F.count(F.lit(1)).alias("active_loans"),
            F.sum("balance").alias("total_outstanding"),
            F.sum("arrears").alias("total_arrears"),
            F.sum("total_paid").alias("total_paid_cum"),
            F.sum("total_due_today").alias("total_due_cum"),
            share(F.col("days_past_due") > 0).alias("delinquency_rate"),
            share(F.col("days_past_due") >= 90).alias("par90_rate"),
            share(is_write_off(F.col("account_status_l1"))).alias("write_off_rate"),
            share(F.col("account_status_l2") == PAID_OFF_STATUS).alias("paid_off_rate"),
            collection_rate().alias("collection_rate_active"),
        )
        .orderBy(F.col("snapshot_date").asc_nulls_last())
    )


def collection_rates(fct: DataFrame) -> DataFrame:
    return book(fct).groupBy("snapshot_date").agg(collection_rate().alias("collection_rate_active"))


def portfolio_growth(kpis: DataFrame, measures: Sequence[str] = ("active_loans", "total_outstanding")) -> DataFrame:
    """First and latest snapshot of each measure and their ratio."""
    ends = kpis.agg(
        *[F.min_by(m, "snapshot_date").cast("double").alias(f"{m}_first") for m in measures],
        *[F.max_by(m, "snapshot_date").cast("double").alias(f"{m}_latest") for m in measures],
    )
    rows = [
        F.struct(F.lit(m).alias("measure"), F.col(f"{m}_first").alias("first"), F.col(f"{m}_latest").alias("latest"))
        for m in measures
    ]
    return ends.select(F.inline(F.array(*rows))).withColumn("ratio", F.try_divide("latest", "first"))


def segment_base(fct: DataFrame, dim: DataFrame, on: str = "loan_id", **segments: str) -> DataFrame:
    """Book rows with segment columns from the dimension; ``segments`` maps name to column.

    A loan the dimension does not know keeps a null segment, apart from 'Unknown'.
    """
    slim = dim.select(on, *[F.col(source).alias(name) for name, source in segments.items()])
    return book(fct).join(slim, on, "left")


def _segment_counts(rows: DataFrame, dims: Sequence[str]) -> DataFrame:
    """Loan counts per snapshot, dimension and segment.

    The rows are counted once per combination of segments and only those few counts are
    turned into one row per dimension, so two dimensions cost no more than one.
    """
    counts = ["n_loans", "n_delinquent", "n_par90", "n_write_off"]
    cells = rows.groupBy("snapshot_date", *dims).agg(
        F.count(F.lit(1)).alias("n_loans"),
        tally(F.col("days_past_due") > 0).alias("n_delinquent"),
        tally(F.col("days_past_due") >= 90).alias("n_par90"),
        tally(is_write_off(F.col("account_status_l1"))).alias("n_write_off"),
    )
    sides = F.array(*[F.struct(F.lit(d).alias("segment_dim"), F.col(d).alias("segment")) for d in dims])
    return (
        cells.select("snapshot_date", F.inline(sides), *counts)
        .groupBy("snapshot_date", "segment_dim", "segment")
        .agg(*[F.sum(c).alias(c) for c in counts])
    )


def segment_kpis(rows: DataFrame, *dims: str) -> DataFrame:
    """Rates per snapshot and segment for one or more dimensions in one pass."""
    n = F.col("n_loans")
    return (
        _segment_counts(rows, dims)
        .select(
            "snapshot_date",
            "segment_dim",
            "segment",
            "n_loans",
            (F.col("n_delinquent") / n).alias("delinquency_rate"),
            (F.col("n_par90") / n).alias("par90_rate"),
            (F.col("n_write_off") / n).alias("write_off_rate"),
        )
        .orderBy("snapshot_date", "segment_dim", F.col("segment").asc_nulls_last())
    )


def divergent_segments(rows: DataFrame, *dims: str, min_loans: int = 200, k: int = 5) -> DataFrame:
    """Segments of the latest snapshot whose delinquency is farthest from the book's.

    The filter on the newest date prunes the scan to that partition; book and segments
    come from the same few counts.
    """
    newest = rows.agg(F.max("snapshot_date")).scalar()
    rate = F.col("n_delinquent") / F.col("n_loans")
    # Every dimension splits the whole book, so its own total is the book's; the window
    # runs over the few counted segments.
    whole = Window.partitionBy("snapshot_date", "segment_dim")
    book_rate = F.sum("n_delinquent").over(whole) / F.sum("n_loans").over(whole)
    return (
        _segment_counts(rows.filter(F.col("snapshot_date") == newest), dims)
        .withColumn("delta_vs_portfolio", rate - book_rate)
        .filter(F.col("n_loans") >= min_loans)
        .select(
            "snapshot_date", "segment_dim", "segment", "n_loans", rate.alias("delinquency_rate"), "delta_vs_portfolio"
        )
        .orderBy(F.abs("delta_vs_portfolio").desc(), "segment_dim", F.col("segment").asc_nulls_last())
        .limit(k)
    )


def latest_top_exposures(fct: DataFrame, dim: DataFrame, attributes: Sequence[str], on: str = "loan_id",
                         keep: Sequence[str] = (), k: int = 200) -> DataFrame:
    """The k largest balances of the newest snapshot with customer attributes.

    The k rows are chosen before the join (the dimension has one row per key, so the join
    cannot change them); their keys, k at most, cut the dimension down as a broadcast.
    Loan key and the kept columns break ties, so both uses of the choice agree.
    """
    newest = fct.agg(F.max("snapshot_date")).scalar()
    order = [F.col("balance").desc_nulls_last(), *[col(c).asc_nulls_last() for c in keep if c != "balance"]]
    chosen = fct.filter(F.col("snapshot_date") == newest).select(*keep).orderBy(*order).limit(k)
    needed = dim.select(on, *attributes).join(F.broadcast(chosen.select(on)), on, "left_semi")
    return chosen.join(needed, on, "left").orderBy(*order)


def survey_with_credit(survey: DataFrame, fct: DataFrame, on: str = "loan_id", keep: Sequence[str] = ("risk_category",)) -> DataFrame:
    """Each response with the newest state of its loan; responses without one drop out.

    The surveyed loans cut the fact down before the newest state is sought; how that join
    is done is left to Spark, which knows the sizes at run time.
    """
    known = fct.select(on, "snapshot_date", *keep).join(survey.select(on).dropna().distinct(), on, "left_semi")
    states = latest_state(known, on)
    return survey.join(states.drop("snapshot_date"), on)


def net_promoter_score() -> Column:
    return F.lit(100.0) * (share(F.col("nps_segment") == "Promoter") - share(F.col("nps_segment") == "Detractor"))


def nps_by_risk(responses: DataFrame, locked: str = "phone_locked_despite_payment",
                delayed: str = "experienced_payment_delay") -> DataFrame:
    return (
        responses.groupBy("risk_category")
        .agg(
            F.count(F.lit(1)).alias("n_responses"),
            F.avg("nps_score").cast("double").alias("mean_nps"),
            share(F.col("nps_segment") == "Promoter").alias("promoter_rate"),
            share(F.col("nps_segment") == "Detractor").alias("detractor_rate"),
            net_promoter_score().alias("net_promoter_score"),
            share(col(locked) == "Yes").alias("pct_locked_after_paying"),
            share(col(delayed) == "Yes").alias("pct_payment_delay"),
        )
        .orderBy(F.col("mean_nps").desc_nulls_last(), "risk_category")
    )


def net_promoter(survey: DataFrame, by: str) -> DataFrame:
    return survey.groupBy(by).agg(F.count(F.lit(1)).alias("n_responses"), net_promoter_score().alias("net_promoter_score"))


def coverage_report(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Filled values and their percentage per column, all columns in one aggregate."""
    counts = df.agg(F.count(F.lit(1)).alias("_rows"), *[F.count(col(c)).alias(c) for c in columns])
    rows = [F.struct(F.lit(c).alias("column"), col(c).alias("n_filled"), F.col("_rows").alias("rows")) for c in columns]
    return counts.select(F.inline(F.array(*rows))).withColumn("filled_pct", percent(F.col("n_filled"), F.col("rows"), 1))


def snapshot_counts(df: DataFrame, key: str = "loan_id") -> DataFrame:
    return df.groupBy("snapshot_date").agg(
        F.count(F.lit(1)).alias("rows"), F.count_distinct(col(key)).alias("unique_loans")
    )

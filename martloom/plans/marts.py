"""Analytic marts as functions of tables and column names."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martloom.functions import bands as B
from martloom.functions.columns import as_col, as_list
from martloom.functions.dates import iso_year, week_label
from martloom.functions.numbers import (
    exact_percent,
    money_mean,
    money_sum,
    percent,
    ratio,
    rounded_money_mean,
)
from martloom.operators.aggregates import conditional_counts, distinct_counts, majority, sorted_set
from martloom.operators.ranks import global_ranks, share_of_max, top_n_per_group
from martloom.operators.star import Dim, star_join
from martloom.session import checkpointed


def concentration_index(
    df: DataFrame,
    group: str | list[str],
    category: str,
    member: str,
    members_name: str = "members",
    categories_name: str = "categories",
    index_name: str = "hhi",
    band_name: str = "diversity_band",
) -> DataFrame:
    """Herfindahl-Hirschman index of each group over its categories.

    A category's share is its distinct members over the sum of them all, so
    the index is sum(c^2) / sum(c)^2 and needs no join back. A NULL category
    has a share but is not counted as a category.
    """
    group = as_list(group)
    c = F.col("_c").cast("double")
    sizes = distinct_counts(df, [*group, category], member, "_c")
    indexed = sizes.groupBy(*group).agg(
        F.sum("_c").alias(members_name),
        F.count(category).alias(categories_name),
        F.round(F.try_divide(F.sum(c * c), F.sum(c) * F.sum(c)), 4).alias(index_name),
    )
    band = B.band_at_most(index_name, B.DIVERSITY_BANDS, B.DIVERSITY_OTHERWISE)
    return indexed.withColumn(band_name, band)


def participation_ranking(
    df: DataFrame,
    member: str | list[str],
    item: str,
    title: str,
    count_name: str = "items",
    titles_name: str = "titles",
) -> DataFrame:
    """Per member: distinct items and the sorted set of their titles.

    Both come from the distinct (member, item, title) rows, so the facts are read once.
    """
    member = as_list(member)
    pairs = df.select(*member, item, title).distinct()
    return pairs.groupBy(*member).agg(
        F.count_distinct(item).alias(count_name), F.sort_array(F.collect_set(title)).alias(titles_name)
    )


def future_events(df: DataFrame, date: str, as_of: dt.date | None = None) -> DataFrame:
    """Rows dated after ``as_of`` (today when not given)."""
    day = F.current_date() if as_of is None else F.lit(as_of)
    return df.filter(F.col(date) > day)


def weekly_density(
    calendar: DataFrame,
    events: DataFrame,
    date: str | Column,
    event: str,
    iso_years: bool = False,
    count_name: str = "events",
) -> DataFrame:
    """Distinct events per week of the calendar; weeks without one appear with 0.

    Weeks are (calendar year, ISO week number), so 1 January may carry week
    52 or 53 of its own calendar year; ``iso_years`` uses the ISO year. Only
    events on a day the calendar has are counted.
    """
    year_of = iso_year if iso_years else F.year
    days = calendar.select(F.col("date").cast("date").alias("_day")).distinct()
    weeks = calendar.select(year_of("date").alias("year"), "iso_week").distinct()
    daily = events.select(F.to_date(as_col(date)).alias("_day"), F.col(event).alias("_event"))
    dated = daily.distinct().join(days, "_day", "left_semi").select(
        year_of("_day").alias("year"), F.weekofyear("_day").alias("iso_week"), "_event"
    )
    counted = distinct_counts(dated, ["year", "iso_week"], "_event", "_n")
    n = F.coalesce("_n", F.lit(0).cast("bigint"))
    return weeks.join(counted, ["year", "iso_week"], "left").select(
        "year",
        "iso_week",
        week_label("year", "iso_week").alias("year_week"),
        n.alias(count_name),
        (n > 0).alias("has_events"),
    )


def attendance_rate(
    presence: DataFrame,
    events: DataFrame,
    member: str,
    event: str,
    period: str,
    kind: str,
    attended_name: str = "attended",
    total_name: str = "total",
) -> DataFrame:
    """Share of the events of a period and kind that each member attended.

    ``presence`` has (member, event), ``events`` has one row per event with
    its period and kind. Presence is reduced to distinct pairs before it
    meets the events, after which counting rows counts events.
    """
    pairs = presence.select(member, event).distinct()
    attended = (
        star_join(pairs, Dim(events, [(event, event)], [period, kind]))
        .groupBy(member, period, kind)
        .agg(F.count("*").alias(attended_name))
    )
    return attendance_from_counts(
        attended, totals_by(events, period, kind, event, total_name), period, kind,
        attended_name, total_name,
    )


def totals_by(events: DataFrame, period: str, kind: str, event: str, name: str) -> DataFrame:
    return distinct_counts(events, [period, kind], event, name)


def attendance_from_counts(
    attended: DataFrame,
    totals: DataFrame,
    period: str,
    kind: str,
    attended_name: str = "attended",
    total_name: str = "total",
) -> DataFrame:
    """Join both counts; adds ``attendance_rate`` (4 digits) and ``attendance_percent`` (2)."""
    return attended.join(totals, [period, kind]).withColumns(
        {
            "attendance_rate": ratio(attended_name, total_name, 4),
            "attendance_percent": percent(attended_name, total_name, 2),
        }
    )


def period_comparison(
    events: DataFrame,
    keys: list[str],
    event: str,
    week: str,
    unit: str,
    events_name: str = "events",
    mean_name: str = "events_per_week",
    units_name: str = "units",
) -> DataFrame:
    """Per key: distinct events, events per week that had any, distinct units.

    ``week`` may be any key that tells weeks apart. Events and weeks are counted over
    their distinct pairs, units over theirs, so no count expands the events' rows.
    """
    pairs = events.select(*keys, event, week).distinct()
    counted = pairs.groupBy(*keys).agg(
        F.count_distinct(event).alias(events_name), F.count_distinct(week).alias("_weeks")
    )
    units = distinct_counts(events, keys, unit, "_units")
    units = units.select(*[F.col(k).alias(f"_u_{k}") for k in keys], "_units")
    same = [F.col(k).eqNullSafe(F.col(f"_u_{k}")) for k in keys]
    return counted.join(units, same).select(
        *keys,
        events_name,
        ratio(events_name, "_weeks", 2).alias(mean_name),
        F.col("_units").alias(units_name),
    )


def top_n_monthly(
    facts: DataFrame,
    group: str,
    months: list[str],
    amount: str | Column,
    member: str,
    n: int = 10,
    members_name: str = "members",
    rows_name: str = "rows",
    total_name: str = "total",
    rank: str = "rank",
) -> DataFrame:
    """The ``n`` groups with the highest total amount per month.

    ``months`` are the columns that make up the period. Equal totals are
    ordered by group.
    """
    totals = facts.groupBy(*months, group).agg(
        F.count_distinct(member).alias(members_name),
        F.count("*").alias(rows_name),
        money_sum(amount).cast("double").alias(total_name),
    )
    order = [F.col(total_name).desc_nulls_last(), F.col(group).asc_nulls_first()]
    return top_n_per_group(totals, months, order, n, rank)


def zscore_outliers(
    df: DataFrame,
    group: str | list[str],
    value: str,
    keep: list[str],
    mean_name: str = "group_mean",
    spread_name: str = "group_stddev",
    band_name: str = "outlier_band",
    amounts: bool = False,
) -> DataFrame:
    """Standard score of each row within its group, with a band on its rounded size.

    Groups without spread (one row, or all values equal) are left out. The
    statistics are aggregated, so they combine map-side and a group may be
    of any size; a window would bring each group into one task. They are
    joined back on a key that is unique on their side. ``amounts`` says that
    the values are two-digit amounts, whose means are then exact.
    """
    group = as_list(group)
    mean = money_mean(value) if amounts else F.avg(value)
    shown_mean = rounded_money_mean(value) if amounts else F.round(F.avg(value), 2)
    stats = (
        df.groupBy(*group)
        .agg(
            mean.alias("_mean"),
            shown_mean.alias(mean_name),
            F.stddev_samp(value).alias("_sd"),
        )
        .filter(F.col("_sd") > 0)
        .withColumn(spread_name, F.round("_sd", 2))
    )
    z = F.round(F.try_divide(F.col(value) - F.col("_mean"), F.col("_sd")), 2)
    return (
        df.select(*dict.fromkeys([*keep, *group, value]))
        .join(stats, group)
        .select(
            *dict.fromkeys([*keep, *group]),
            F.round(value, 2).alias(value),
            mean_name,
            spread_name,
            z.alias("z_score"),
            B.band_below(F.abs(z), B.OUTLIER_BANDS, B.OUTLIER_OTHERWISE).alias(band_name),
        )
    )


def alignment(
    votes: DataFrame,
    group: str | list[str],
    choice: str,
    aligned_name: str = "aligned",
    total_name: str = "total",
    percent_name: str = "percent_aligned",
    band_name: str = "alignment_band",
) -> DataFrame:
    """Per group (say caucus and ballot): how many votes agree with the majority.

    The fan-out is read once, into a histogram. If most votes are NULL none
    of them counts as aligned.
    """
    group = as_list(group)
    top = majority(votes, group, choice, votes="_votes", total=total_name)
    agreeing = F.when(F.col(choice).isNotNull(), F.col("_votes")).otherwise(F.lit(0))
    share = exact_percent(aligned_name, total_name)
    return (
        top.withColumn(aligned_name, agreeing.cast("bigint"))
        .select(*group, aligned_name, total_name, share.alias(percent_name))
        .withColumn(
            band_name, B.band_at_least(percent_name, B.ALIGNMENT_BANDS, B.ALIGNMENT_OTHERWISE)
        )
    )


def cohesion(
    aligned: DataFrame,
    group: str | list[str],
    percent_name: str = "percent_aligned",
    low_spread_below: float = 10,
) -> DataFrame:
    """Per group over its alignment percentages: count, mean, range, spread, bands.

    The percentages have two digits, so their mean is exact. The band looks at
    the rounded mean, the low-spread flag at the unrounded
    deviation; a single ballot has no deviation and no low spread.
    """
    p = F.col(percent_name)
    mean = rounded_money_mean(p)
    return aligned.groupBy(*as_list(group)).agg(
        F.count("*").alias("ballots"),
        mean.alias("mean_alignment"),
        F.min(p).alias("min_alignment"),
        F.max(p).alias("max_alignment"),
        B.band_at_least(mean, B.COHESION_BANDS, B.COHESION_OTHERWISE).alias("cohesion_band"),
        F.round(F.stddev_samp(p), 2).alias("stddev_alignment"),
        B.yes_no(F.stddev_samp(p) < low_spread_below).alias("has_low_spread"),
    )


def engagement_score(
    members: DataFrame,
    presence: DataFrame,
    votes: DataFrame,
    member: str,
    attributes: list[str],
    event: str,
    ballot: str,
    choice: str,
    choice_names: dict[str, str],
    events_name: str = "events",
    ballots_name: str = "ballots",
    score_name: str = "score",
    rank_name: str = "rank",
    percentile_name: str = "percentile",
) -> DataFrame:
    """Score members by 40 % events attended and 60 % ballots taken part in.

    Both counts are relative to the best member's. Only members with at
    least one of each appear. Events and votes are counted per member before
    anything is joined. ``choice_names`` maps output columns to the vote
    kinds they count, compared in upper case.
    """
    attended = distinct_counts(presence, member, event, events_name)
    voted = votes.groupBy(member).agg(
        F.count_distinct(ballot).alias(ballots_name),
        *conditional_counts(F.upper(choice), choice_names),
    )
    counted = members.select(member, *attributes).join(attended, member).join(voted, member)
    # one row per member, read for the maxima, the ranks and the result
    counted = checkpointed(counted)
    shares = share_of_max(counted, {events_name: "_events", ballots_name: "_ballots"})
    scored = shares.withColumn(
        score_name, F.col("_events") * F.lit(0.4) + F.col("_ballots") * F.lit(0.6)
    ).drop("_events", "_ballots")
    return global_ranks(scored, score_name, rank_name, percentile_name, stored=True)


def engagement_by_group(
    scores: DataFrame,
    group: str,
    score: str = "score",
    rank_name: str = "rank",
) -> DataFrame:
    """Members, mean, best and worst score per group; rank and band by the unrounded mean."""
    base = scores.groupBy(group).agg(
        F.count("*").alias("members"),
        F.avg(score).alias("_mean"),
        F.max(score).alias("_max"),
        F.min(score).alias("_min"),
    )
    ranked = global_ranks(base, "_mean", dense_desc=rank_name)
    return ranked.select(
        group,
        "members",
        F.round("_mean", 2).alias("mean_score"),
        F.round("_max", 2).alias("max_score"),
        F.round("_min", 2).alias("min_score"),
        rank_name,
        B.band_at_least("_mean", B.ALIGNMENT_BANDS, B.ALIGNMENT_OTHERWISE).alias("score_band"),
    )


def inquiry_catalog(inquiries: DataFrame, start: str, end: str) -> DataFrame:
    """Adds whether a start and an end date are known."""
    return inquiries.withColumns(
        {
            "has_start": B.yes_no(F.col(start).isNotNull()),
            "has_end": B.yes_no(F.col(end).isNotNull()),
        }
    )


def open_status(
    end: str | Column,
    as_of: dt.date | None = None,
    open_label: str = "Em andamento",
    closed_label: str = "Encerrada",
) -> Column:
    """Open while the end is unknown or not before ``as_of``."""
    day = F.current_date() if as_of is None else F.lit(as_of)
    return F.when(as_col(end) < day, F.lit(closed_label)).otherwise(F.lit(open_label))

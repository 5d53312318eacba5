"""Match results jobs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType

from tidewater.operators.aggregates import group_agg, numeric_sums


def team_table(results: DataFrame) -> DataFrame:
    """Per team, wins, draws, goals and games over home and away sides.

    Draws are taken on the full match list before wins are filtered (the source cut away rows to
    wins first, so away draws were always empty; corrected here). One pass per side, appended
    (U1), then every numeric column summed by team (A3).
    """
    home = results.select(F.col("home_team").alias("team"),
                          F.when(F.col("home_score") > F.col("away_score"), 1).otherwise(0).alias("wins"),
                          F.when(F.col("home_score") == F.col("away_score"), 1).otherwise(0).alias("draws"),
                          F.col("home_score").alias("goals"), F.lit(1).alias("played"))
    away = results.select(F.col("away_team").alias("team"),
                          F.when(F.col("away_score") > F.col("home_score"), 1).otherwise(0).alias("wins"),
                          F.when(F.col("home_score") == F.col("away_score"), 1).otherwise(0).alias("draws"),
                          F.col("away_score").alias("goals"), F.lit(1).alias("played"))
    return numeric_sums(home.unionByName(away), ["team"])


def outcome_rows(results: DataFrame, team: str | None = None) -> DataFrame:
    """The matches that a team won or drew, with columns ``team``, ``side`` (local, visitante) and ``outcome`` (gana, empate) before the
    match's own; of one team, or of all. One pass: a drawn match gives a row for either side.

    The source cut the away matches to wins before it looked for draws, so away draws were always empty; corrected here. A
    match without a score has no outcome."""
    home, away = F.col("home_score"), F.col("away_score")
    side = lambda name, col, won: F.struct(F.col(col).alias("team"), F.lit(name).alias("side"),
                                           F.when(won, "gana").when(home == away, "empate").alias("outcome"))
    rows = results.select(F.explode(F.array(side("local", "home_team", home > away), side("visitante", "away_team", away > home))).alias("__side"), *results.columns)
    out = rows.select("__side.*", *results.columns).where(F.col("outcome").isNotNull())
    return out if team is None else out.where(F.col("team") == team)


def home_sums(results: DataFrame, team: str | None = None) -> DataFrame:
    """B39 (A3): every numeric column summed over the matches at home, per team or for one; true counts as 1, as in the source."""
    rows = results if team is None else results.where(F.col("home_team") == team)
    flags = [f.name for f in results.schema.fields if isinstance(f.dataType, BooleanType)]
    return numeric_sums(rows.withColumns({c: F.col(c).cast("int") for c in flags}) if flags else rows, ["home_team"])


def penalty_scorers(goals: DataFrame) -> DataFrame:
    """B40 (F1, A5): dated penalty goals per (scorer, team), counted in column ``date``, most first (ties by name)."""
    pens = goals.where(F.col("penalty") == True)  # noqa: E712
    counts = group_agg(pens, ["scorer", "team"], {"date": ("count", "date")})
    return counts.orderBy(F.desc("date"), F.asc("scorer"), F.asc("team"))

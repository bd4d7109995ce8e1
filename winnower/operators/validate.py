"""Judge rows by rules and split them into branches."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from winnower.contract import STRICT, Policy, Rule, all_of

VALID, DEAD, UNDETERMINED = "valid", "dead", "undetermined"


def validity(rules: Sequence[Rule], policy: Policy = STRICT) -> Column:
    """All rules hold. Null only under a three-valued policy."""
    joint = all_of(rule.outcome() for rule in rules)
    return joint if policy.three_valued else F.coalesce(joint, F.lit(False))


def violated(rule: Rule, policy: Policy = STRICT) -> Column:
    """Never null: an undecided rule counts as violated unless the policy is three-valued."""
    return ~F.coalesce(rule.outcome(), F.lit(policy.three_valued))


def error_text(rules: Sequence[Rule], policy: Policy = STRICT) -> Column:
    """Names of the violated rules, comma-separated; empty when there are none."""
    return F.concat_ws(",", *[F.when(violated(r, policy), F.lit(r.name)) for r in rules])


def branch_of(is_valid: Column) -> Column:
    return F.when(is_valid, F.lit(VALID)).when(~is_valid, F.lit(DEAD)).otherwise(F.lit(UNDETERMINED))


def judge(df: DataFrame, rules: Sequence[Rule], policy: Policy = STRICT) -> DataFrame:
    """Add ``is_valid`` and ``branch``."""
    return df.withColumn("is_valid", validity(rules, policy)).withColumn("branch", branch_of(F.col("is_valid")))


def pick(df: DataFrame, condition: Column, *columns: str | Column) -> DataFrame:
    """Rows that meet the condition, projected to the columns.

    For conditions that are costly to evaluate, such as those on parsed messages. A plain filter would be
    pushed below the parser, which would then run a second time; an empty expansion stays where it is.
    """
    return df.select(F.inline(F.when(condition, F.array(F.struct(*(columns or df.columns))))))


def valid_rows(judged: DataFrame) -> DataFrame:
    return judged.where(F.col("is_valid"))


def dead_rows(judged: DataFrame) -> DataFrame:
    return judged.where(~F.col("is_valid"))


def undetermined_rows(judged: DataFrame) -> DataFrame:
    return judged.where(F.col("is_valid").isNull())


def explode_errors(df: DataFrame, keys: Sequence[str], errors: str = "rules") -> DataFrame:
    """One row per name in a comma-separated list.

    Rows without a name are dropped after the expansion. A filter before it would be pushed below the
    projection and evaluate every rule a second time.
    """
    return df.select(*keys, F.explode(F.split(errors, ",")).alias("rule")).where(F.col("rule") != "")


def rule_violations(df: DataFrame, rules: Sequence[Rule], keys: Sequence[str], policy: Policy = STRICT) -> DataFrame:
    """One row per key and violated rule."""
    return explode_errors(df.select(*keys, error_text(rules, policy).alias("rules")), keys)


def violation_summary(df: DataFrame, rules: Sequence[Rule], policy: Policy = STRICT) -> DataFrame:
    """Violations per rule, zero included.

    Each task counts all rules in one pass and sends a single row on, so nothing depends on how violations
    are spread over the rules.
    """
    counts = df.agg(*[F.count_if(violated(r, policy)).alias(f"n{i}") for i, r in enumerate(rules)])
    return counts.select(
        F.explode(F.array(*[
            F.struct(F.lit(r.name).alias("rule"), F.col(f"n{i}").alias("violations")) for i, r in enumerate(rules)
        ])).alias("line")
    ).select("line.*")


def in_force(df: DataFrame, contract, moment: str) -> DataFrame:
    """Rows the contract applies to, stamped with its version."""
    return df.where(F.col(moment) >= F.lit(contract.valid_from).cast("timestamp")).withColumn(
        "schema_version", F.lit(contract.version)
    )

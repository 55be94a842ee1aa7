"""Release policy: ordered rules decide whether a source's text may be released."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evidentia.functions import ids
from evidentia.functions.urls import domain, in_domains


def decide(url: Column, text: Column, license_: Column, policy: Column, config: dict) -> Column:
    """A struct ``(license_status, release_policy, raw_text_release, reason)`` from the first rule that holds.

    Excluded domain, restricted domain, restriction phrase in the text (the first in the configuration),
    explicit conservative policy, government page, explicit open policy, default.
    """
    host = domain(url)

    def out(a: Column | str, b: Column | str, raw: bool, why: Column | str) -> Column:
        lit = lambda x: F.lit(x) if isinstance(x, str) else x
        return F.struct(lit(a).alias("license_status"), lit(b).alias("release_policy"), F.lit(raw).alias("raw_text_release"), lit(why).alias("reason"))

    phrases = config.get("strong_restriction_phrases", [])
    phrase = F.coalesce(*(F.when(F.contains(text, F.lit(p)), F.lit(p)) for p in phrases), F.lit(None).cast("string"))
    defaults = config.get("defaults", {})
    return (
        F.when(in_domains(host, config.get("excluded_domains", [])), out("forbidden", "exclude", False, "domain is excluded"))
        .when(in_domains(host, config.get("restricted_domains", [])), out("restricted", "metadata_and_facts_only", False, "domain is restricted"))
        .when(phrase.isNotNull(), out("restricted", "metadata_and_facts_only", False, F.concat(F.lit("page contains restriction phrase: "), phrase)))
        .when(policy.isin("local_only", "exclude", "metadata_and_facts_only"), out(F.when(license_ != "", license_).otherwise("unclear"), policy, False, "explicit conservative policy"))
        .when(in_domains(host, config.get("government_domains", [])) & (policy == "government_public"), out("government_public", "government_public", True, "government page without override"))
        .when((license_ == "open") & (policy == "full_text_allowed"), out("open", "full_text_allowed", True, "explicit open policy"))
        .otherwise(out(defaults.get("unknown_license_status", "unclear"), defaults.get("unknown_release_policy", "metadata_and_facts_only"), bool(defaults.get("unknown_raw_text_release", False)), "license could not be verified; conservative default applied"))
    )


def may_release_text(policy: Column, raw: Column) -> Column:
    """Whether open chunks may be built."""
    return raw & policy.isin("full_text_allowed", "government_public")


def seed_sources(seeds: DataFrame, config: dict, day: str | None = None) -> DataFrame:
    """Registry rows of seeds (source_id, title, url, publisher, source_type, region, topic, license_status, release_policy, enabled, notes) by the policy's rules.

    A seed without an id gets that of its address; disabled ones are skipped; the rule's reason is added to the notes.
    """
    text = lambda c, other="": F.coalesce(F.nullif(F.col(c), F.lit("")), F.lit(other))
    decided = seeds.withColumn("d", decide(F.col("url"), F.lit(""), text("license_status"), text("release_policy"), config))
    names = lambda c: F.coalesce(c, F.array().cast("array<string>")).alias(c)
    today = F.lit(day) if day else F.date_format(F.current_date(), "yyyy-MM-dd")
    return decided.select(
        F.coalesce(F.nullif("source_id", F.lit("")), ids.source_id(F.col("url"))).alias("source_id"), "title", text("publisher").alias("publisher"), text("source_type", "other").alias("source_type"), "url", domain(F.col("url")).alias("domain"),
        names("region"), names("topic"), today.alias("retrieved_at"), "d.license_status", "d.release_policy", "d.raw_text_release",
        F.when(F.coalesce("enabled", F.lit(True)), "pending").otherwise("skipped").alias("crawl_status"), F.concat_ws("; ", F.nullif("notes", F.lit("")), F.col("d.reason")).alias("notes"),
    )

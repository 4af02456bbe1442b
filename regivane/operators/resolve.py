"""Entity resolution of municipalities against the code catalog.

Stages come in this order, which is part of the result: corrections of the state, a simple
and an aggressive lookup, overrides for what is unmatched, sentinel codes (which overwrite a
match), and a code for what is still unmatched.  The planner or adaptive execution broadcasts
a rule table where its size allows and shuffles it beyond; only the overrides, whose size the
planner overrates, are counted first.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from regivane import schemas as S
from regivane.functions import text
from regivane.operators.dedup import keep_first, keep_last, keep_last_by_address
from regivane.storage import sized_broadcast

_GEO = ["cvegeo", "cve_estado", "cve_mun", "state", "municipality"]


def normalize_records(raw: DataFrame) -> DataFrame:
    """Add normalised names and the padded state code, which is null for the unknown state."""
    return raw.withColumns(
        {
            "municipio_norm": text.normalize_text(F.col("municipio")),
            "municipio_norm_agg": text.normalize_aggressive(F.col("municipio")),
            "estado_norm": text.normalize_text(F.col("estado")),
            "cve_estado_raw": F.when(F.col("id_estado") == S.UNKNOWN_STATE_ID, None).otherwise(text.zfill(F.col("id_estado"), 2)),
        }
    )


def dedup_records(records: DataFrame, *within: str) -> DataFrame:
    """Of records with the same key the one of the highest ordinal, a number that no other record (of ``within``) has."""
    return keep_last_by_address(records, [*within, *S.RECORD_KEY], [*within, "ordinal"])


def build_reference(catalog: DataFrame) -> DataFrame:
    """Padded codes and normalised names of the catalog (CVEGEO, CVE_ENT, CVE_MUN, NOM_ENT, NOM_MUN, ordinal)."""
    return catalog.select(
        text.pad_code(F.col("CVEGEO"), 5).alias("cvegeo"),
        text.pad_code(F.col("CVE_ENT"), 2).alias("cve_estado"),
        text.pad_code(F.col("CVE_MUN"), 3).alias("cve_mun"),
        text.normalize_text(F.col("NOM_ENT")).alias("state"),
        text.normalize_text(F.col("NOM_MUN")).alias("municipality"),
        text.normalize_aggressive(F.col("NOM_MUN")).alias("municipality_agg"),
        "ordinal",
    )


def simple_lookup(ref: DataFrame) -> DataFrame:
    """First catalog row for each state and name."""
    return keep_first(ref, ["cve_estado", "municipality"], "ordinal")


def aggressive_counts(ref: DataFrame) -> DataFrame:
    """Catalog rows for each state and aggressive name."""
    return ref.groupBy("cve_estado", "municipality_agg").agg(F.count("*").alias("n_rows"))


def aggressive_lookup(ref: DataFrame) -> DataFrame:
    """Catalog rows whose state and aggressive name no other row has."""
    rest = F.struct(*_GEO)
    once = ref.groupBy(F.col("cve_estado").alias("key_state"), "municipality_agg").agg(F.count("*").alias("n"), F.min_by(rest, "ordinal").alias("geo")).where("n = 1")
    return once.select("key_state", "municipality_agg", "geo.*")


def _rule_name() -> Column:
    """The normalised name of a rule; a rule without one names the records whose name is empty."""
    return F.coalesce(text.normalize_text(F.col("raw_municipio")), F.lit("")).alias("key_name")


def correction_rules(corrections: DataFrame) -> DataFrame:
    """(key_state, key_name, target_state); the last of equal keys."""
    padded = corrections.select(
        text.pad_code(F.col("source_id_estado"), 2).alias("key_state"),
        _rule_name(),
        text.pad_code(F.col("target_cve_estado"), 2).alias("target_state"),
        "ordinal",
    )
    return keep_last(padded, ["key_state", "key_name"], "ordinal").drop("ordinal")


def apply_corrections(records: DataFrame, rules: DataFrame) -> DataFrame:
    """Replace the state code where a rule names state and municipality.

    The unknown state has no code, so no rule can name it.
    """
    keyed = records.withColumn("__state", F.coalesce("cve_estado_raw", F.lit("")))
    joined = keyed.join(rules, (F.col("__state") == F.col("key_state")) & (F.col("municipio_norm") == F.col("key_name")), "left")
    fixed = joined.withColumns({"cve_estado_raw": F.coalesce("target_state", "cve_estado_raw"), "corrected": F.col("target_state").isNotNull()})
    return fixed.drop("__state", "key_state", "key_name", "target_state")


def geo_join(records: DataFrame, ref: DataFrame) -> DataFrame:
    """Simple lookup, then the aggressive one; each geo column takes the first that is not null."""
    one = simple_lookup(ref).select(F.col("cve_estado").alias("s_key"), F.col("municipality").alias("s_name"), *(F.col(c).alias(f"s_{c}_") for c in _GEO), F.lit(True).alias("s_hit"))
    two = aggressive_lookup(ref).select(F.col("key_state").alias("a_key"), F.col("municipality_agg").alias("a_name"), *(F.col(c).alias(f"a_{c}_") for c in _GEO), F.lit(True).alias("a_hit"))
    joined = records.join(one, (F.col("cve_estado_raw") == F.col("s_key")) & (F.col("municipio_norm") == F.col("s_name")), "left")
    joined = joined.join(two, (F.col("cve_estado_raw") == F.col("a_key")) & (F.col("municipio_norm_agg") == F.col("a_name")), "left")
    kind = F.when(F.col("s_hit"), "simple").when(F.col("a_hit"), "aggressive").when(F.col("cve_estado_raw").isNull(), "unknown_state").otherwise("unmatched")
    geo = [F.coalesce(f"s_{c}_", f"a_{c}_").alias(f"geo_{c}") for c in _GEO]
    return joined.select(*records.columns, *geo, kind.alias("match_type"))


def override_rules(overrides: DataFrame, ref: DataFrame) -> DataFrame:
    """(key_state, key_name, geo columns) of the overrides whose code is in the catalog; the last of equal keys."""
    padded = overrides.select(text.pad_code(F.col("raw_id_estado"), 2).alias("key_state"), _rule_name(), text.pad_code(F.col("cvegeo"), 5).alias("code"), "ordinal")
    catalog = keep_last(ref, ["cvegeo"], "ordinal").select(*(F.col(c).alias(f"o_{c}") for c in _GEO))
    found = padded.join(catalog, F.col("code") == F.col("o_cvegeo")).drop("code")
    return keep_last(found, ["key_state", "key_name"], "ordinal").drop("ordinal")


def unmatched_overrides(overrides: DataFrame, ref: DataFrame) -> DataFrame:
    """Overrides whose code the catalog lacks."""
    return overrides.withColumn("cvegeo", text.pad_code(F.col("cvegeo"), 5)).join(ref.select("cvegeo").distinct(), "cvegeo", "left_anti")


def apply_overrides(records: DataFrame, rules: DataFrame) -> DataFrame:
    """Give unmatched rows the geography that a rule states for their (corrected) state and name."""
    keyed = records.withColumn("__state", F.when(F.col("match_type") == "unmatched", F.coalesce("cve_estado_raw", F.lit(""))))
    joined = keyed.join(sized_broadcast(rules), (F.col("__state") == F.col("key_state")) & (F.col("municipio_norm") == F.col("key_name")), "left")
    hit = F.col("key_state").isNotNull()
    columns = {f"geo_{c}": F.when(hit, F.col(f"o_{c}")).otherwise(F.col(f"geo_{c}")) for c in _GEO}
    columns["match_type"] = F.when(hit, F.lit("override")).otherwise(F.col("match_type"))
    return joined.withColumns(columns).select(*records.columns)


def assign_sentinels(records: DataFrame) -> DataFrame:
    """Codes for the unknown state and for the two labels that name no municipality; they overwrite a match."""
    unknown = F.coalesce(F.col("id_estado") == S.UNKNOWN_STATE_ID, F.lit(False))
    label = F.coalesce(F.create_map(*(F.lit(v) for kv in S.SENTINEL_MUNICIPALITIES.items() for v in kv))[F.col("municipio_norm")], F.lit(""))
    labelled = label != ""
    local = ~unknown & labelled
    columns = {
        "geo_cvegeo": F.when(unknown, S.UNKNOWN_STATE_CVEGEO).when(local, F.concat("cve_estado_raw", label)).otherwise(F.col("geo_cvegeo")),
        "geo_cve_estado": F.when(unknown, S.UNKNOWN_STATE_CODE).when(local, F.col("cve_estado_raw")).otherwise(F.col("geo_cve_estado")),
        "geo_cve_mun": F.when(unknown & labelled, label).when(unknown, "998").when(local, label).otherwise(F.col("geo_cve_mun")),
        "geo_state": F.when(unknown, S.UNKNOWN_STATE_NAME).when(local, F.col("estado_norm")).otherwise(F.col("geo_state")),
        "geo_municipality": F.when(labelled, F.col("municipio_norm")).when(unknown, None).otherwise(F.col("geo_municipality")),
        "match_type": F.when(unknown, "sentinel_unknown_state").when(local, F.concat(F.lit("sentinel_muni_"), label)).otherwise(F.col("match_type")),
    }
    return records.withColumns(columns)


def assign_unresolved(records: DataFrame) -> DataFrame:
    """A code for what is still unmatched, under its own name."""
    open_ = F.col("match_type") == "unmatched"
    values = {
        "geo_cvegeo": F.lit(S.UNRESOLVED_CVEGEO),
        "geo_cve_estado": F.lit(S.UNKNOWN_STATE_CODE),
        "geo_cve_mun": F.lit(S.UNRESOLVED_MUN),
        "geo_state": F.lit(S.UNRESOLVED_NAME),
        "geo_municipality": F.col("municipio_norm"),
        "match_type": F.lit("unresolved_state_99"),
    }
    return records.withColumns({c: F.when(open_, v).otherwise(F.col(c)) for c, v in values.items()})


def resolve(records: DataFrame, ref: DataFrame, corrections: DataFrame, overrides: DataFrame) -> DataFrame:
    """All stages over normalised, deduplicated records."""
    fixed = apply_corrections(records, correction_rules(corrections))
    matched = apply_overrides(geo_join(fixed, ref), override_rules(overrides, ref))
    return assign_unresolved(assign_sentinels(matched))


_NAME = ["id_estado", "estado", "municipio"]


def resolve_by_name(records: DataFrame, ref: DataFrame, corrections: DataFrame, overrides: DataFrame) -> DataFrame:
    """:func:`resolve` over records as they were read, through a dictionary of their distinct names.

    All that the stages look at follows from a record's state and municipality, which repeat every
    month: each distinct one is normalised and resolved once, and the records join the result.
    """
    names = normalize_records(records.select(*_NAME).distinct())
    known = resolve(names, ref, corrections, overrides)
    added = [c for c in known.columns if c not in _NAME]
    known = known.select(*(F.col(c).alias(f"__{c}") for c in _NAME), *added)
    same = F.lit(True)
    for c in _NAME:
        same = same & F.col(c).eqNullSafe(F.col(f"__{c}"))
    return records.join(known, same, "left").select(*records.columns, *added)

"""Identity resolution: which lead records describe the same person, and one golden record per person.

Two records match by the first rule that fires:

1. equal normalized email                                             confidence 100
2. equal email domain, name similarity s >= 85                        confidence int(0.9 s)
3. name similarity >= 90 and company similarity >= 90                 confidence 75

Records that agree on what a rule looks at behave alike, so rules run on distinct *nodes*, never on pairs of
records: emails for rule 1, (domain, name) for rule 2, (name, company) for rule 3. A node that holds a third of
all records is one row. Each record has one *anchor* node; the match graph connects anchors only.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leadlake.functions import text
from leadlake.operators.components import connected_components
from leadlake.operators.fuzzy import candidate_pairs, similar_pairs
from leadlake.operators.skew import salted_join, skew_safe_lookup
from leadlake.session import cut_lineage

# Fixed values of the rules.
DOMAIN_NAME_THRESHOLD = 85
COMPANY_THRESHOLD = 90
NAME_THRESHOLD = 90
EXACT_CONFIDENCE = 100
SAME_NAME_CONFIDENCE = 90
COMPANY_CONFIDENCE = 75
DEFAULT_THRESHOLD = 75

EXACT, DOMAIN, COMPANY = "exact_email", "domain_name_fuzzy", "company_name_fuzzy"

GOLDEN_TEXT = ("full_name", "email", "email_domain", "job_title", "seniority", "company_name", "company_domain",
               "industry", "lead_status")
GOLDEN_NUMBERS = ("employee_count", "apollo_score")
GOLDEN_FIELDS = ("full_name", "email", "email_domain", "job_title", "seniority", "company_name", "company_domain",
                 "industry", "employee_count", "apollo_score", "lead_status")
_SEP = "\x1f"


def normal_forms(leads: DataFrame) -> DataFrame:
    """Adds ``m_email``, ``m_domain``, ``m_name`` and ``m_company``: what the rules compare ('' when missing).

    Names and companies have their words sorted, because every rule compares them in that form.
    """
    email = text.normal_email("email")
    name, company = text.normal_name("full_name"), text.normal_name("company_name")
    return leads.withColumns({
        "m_email": email,
        "m_domain": text.domain_part_two(email),
        "m_name": text.sorted_tokens(name),
        "m_company": text.sorted_tokens(company),
    })


def _node(kind: str, *parts: str) -> Column:
    key = F.concat_ws(_SEP, F.lit(kind), *parts)
    present = F.lit(True)
    for part in parts:
        present = present & (F.col(part) != "")
    return F.when(present, key)


def _with_nodes(leads: DataFrame, threshold: int) -> DataFrame:
    """Adds the nodes that can reach the confidence threshold, and the anchor (null: matches nothing)."""
    nothing = F.lit(None).cast("string")
    return normal_forms(leads).withColumns({
        "n_email": _node("e", "m_email") if threshold <= EXACT_CONFIDENCE else nothing,
        "n_domain": _node("d", "m_domain", "m_name") if threshold <= SAME_NAME_CONFIDENCE else nothing,
        "n_company": _node("c", "m_name", "m_company") if threshold <= COMPANY_CONFIDENCE else nothing,
    }).withColumn("anchor", F.coalesce("n_domain", "n_company", "n_email"))


# ---------------------------------------------------------------------------------------------- rules

def exact_email_groups(leads: DataFrame) -> DataFrame:
    """Rule 1: one row per shared email with its records and the number of matching pairs."""
    records = F.col("record_count")
    return (
        normal_forms(leads).filter("m_email != ''").groupBy(F.col("m_email").alias("email"))
        .agg(F.count(F.lit(1)).alias("record_count"))
        .filter(records > 1)
        .withColumn("pair_count", F.expr("record_count * (record_count - 1) div 2"))
    )


def _domain_nodes(forms: DataFrame) -> DataFrame:
    return (
        forms.filter("m_domain != '' and m_name != ''").select("m_domain", "m_name").distinct()
        .select(F.col("m_domain").alias("grp"), F.col("m_name").alias("text"))
    )


def _company_nodes(forms: DataFrame) -> DataFrame:
    return forms.filter("m_name != '' and m_company != ''").select("m_name", "m_company").distinct()


def domain_candidates(leads: DataFrame) -> DataFrame:
    """Rule 2 candidates: distinct names of one domain within the edit budget, before exact scoring."""
    nodes = cut_lineage(_domain_nodes(normal_forms(leads)))
    pairs = candidate_pairs(nodes, nodes, DOMAIN_NAME_THRESHOLD, nodes.count())
    return pairs.select(
        F.col("own_a").alias("domain"), F.least("text_a", "text_b").alias("name_1"), F.greatest("text_a", "text_b").alias("name_2")
    )


def domain_pairs(leads: DataFrame) -> DataFrame:
    """Rule 2 on distinct names: ``domain, name_1, name_2, score, confidence`` with name_1 < name_2."""
    nodes = cut_lineage(_domain_nodes(normal_forms(leads)))
    return similar_pairs(nodes, nodes, DOMAIN_NAME_THRESHOLD, nodes.count()).select(
        F.col("own_a").alias("domain"),
        F.least("text_a", "text_b").alias("name_1"),
        F.greatest("text_a", "text_b").alias("name_2"),
        "score",
        F.floor(F.col("score") * 0.9).cast("int").alias("confidence"),
    )


def similar_companies(companies: DataFrame, total: int) -> DataFrame:
    """Ordered pairs ``company, partner`` of similar companies, each company with itself included."""
    distinct = companies.select("m_company").distinct()
    nodes = distinct.select(F.lit("").alias("grp"), F.col("m_company").alias("text"))
    pair = lambda a, b: F.struct(F.col(a).alias("company"), F.col(b).alias("partner"))
    both = F.explode(F.array(pair("text_a", "text_b"), pair("text_b", "text_a"))).alias("p")
    pairs = similar_pairs(nodes, nodes, COMPANY_THRESHOLD, total).select(both).select("p.*")
    return pairs.unionByName(distinct.select(F.col("m_company").alias("company"), F.col("m_company").alias("partner")))


def company_pairs(leads: DataFrame) -> DataFrame:
    """Rule 3 on distinct (name, company): ``name_1, company_1, name_2, company_2``, first side smaller."""
    nodes = cut_lineage(_company_nodes(normal_forms(leads)))
    return _company_pairs(nodes, nodes.count())


def _pairs_with(new: DataFrame, old: DataFrame, nodes: DataFrame, threshold: int, total: int) -> DataFrame:
    """Similar pairs of the distinct ``nodes`` with at least one end in ``new``, each once; ``old`` are the others. A text has several times
    more keys as the longer side, so that each text takes that side once."""
    return similar_pairs(nodes, new, threshold, total).unionByName(similar_pairs(new, old, threshold, total))


def _company_pairs(forms: DataFrame, total: int, stored: DataFrame | None = None) -> DataFrame:
    """Companies are compared once each, and similar ones are contracted into classes. Names are then compared once per class,
    whatever number of companies they stand in, and only similar names meet the pairs of similar companies. ``forms``
    (``total`` rows) should be materialized, it is read several times. With ``stored``, a part of them that was compared before, names are
    compared only with those that stand in another node; pairs of stored nodes may be among the result."""
    nodes = _company_nodes(forms)
    similar = cut_lineage(similar_companies(nodes, total))
    labels = connected_components(similar, "company", "partner").withColumnRenamed("id", "company")
    classes = similar.select("company").distinct().join(labels, "company", "left").select(
        "company", F.coalesce("component", "company").alias("grp"))
    placed = cut_lineage(salted_join(
        nodes.select(F.col("m_name").alias("name"), F.col("m_company").alias("company")), classes, "company", total))
    texts = placed.select("grp", F.col("name").alias("text")).distinct()
    if stored is None:
        fuzzy = similar_pairs(texts, texts, NAME_THRESHOLD, total)
    else:
        compared = _company_nodes(stored).select(F.col("m_name").alias("name"), F.col("m_company").alias("company"))
        new = cut_lineage(placed.join(compared, ["name", "company"], "left_anti").select("grp", F.col("name").alias("text")).distinct())
        fuzzy = _pairs_with(new, texts.subtract(new), texts, NAME_THRESHOLD, total)
    fuzzy = fuzzy.select(F.col("own_a").alias("grp"), F.col("text_a").alias("name"), F.col("text_b").alias("other"))
    reach = salted_join(placed, similar, "company", total)
    ends = reach.filter("company < partner").withColumn("other", F.col("name")).select(
        "name", "company", "other", "partner"
    ).unionByName(reach.join(fuzzy, ["grp", "name"]).select("name", "company", "other", "partner"))
    there = placed.select(F.col("name").alias("other"), F.col("company").alias("partner"))
    end = lambda name, company: F.struct(F.col(name).alias("name"), F.col(company).alias("company"))
    one, two = end("name", "company"), end("other", "partner")
    return ends.join(there, ["other", "partner"], "left_semi").select(
        F.least(one, two).alias("lo"), F.greatest(one, two).alias("hi")).select(
        F.col("lo.name").alias("name_1"), F.col("lo.company").alias("company_1"),
        F.col("hi.name").alias("name_2"), F.col("hi.company").alias("company_2"),
    )


# ------------------------------------------------------------------------------------------ match log

def _pairs_within(counts: DataFrame, group: Sequence[str]) -> DataFrame:
    """n(n-1)/2 per group minus the same sum over the finer ``claim`` groups an earlier rule has taken."""
    n = F.sum("n")
    taken = F.sum(F.when(F.col("claim").isNotNull(), F.expr("n * (n - 1) div 2")).otherwise(0))
    return counts.groupBy(*group).agg(n.alias("n"), taken.alias("taken")).withColumn(
        "pair_count", F.expr("n * (n - 1) div 2") - F.col("taken")
    )


def _claimed_across(pairs: DataFrame, counts: DataFrame) -> DataFrame:
    """Record pairs between two nodes that share a claim, as ``lo, hi, taken``.

    A pair is looked up from its node with fewer claims, so a node that holds very many costs each of its
    partners only the partner's own claims.
    """
    claims = counts.filter("claim is not null")
    width = claims.groupBy("node").agg(F.count(F.lit(1)).alias("width"))
    of = lambda end: width.select(F.col("node").alias(end), F.col("width").alias(f"{end}_width"))
    small_first = F.col("lo_width") <= F.col("hi_width")
    routed = pairs.select("lo", "hi").join(of("lo"), "lo").join(of("hi"), "hi").select(
        "lo", "hi",
        F.when(small_first, F.col("lo")).otherwise(F.col("hi")).alias("near"),
        F.when(small_first, F.col("hi")).otherwise(F.col("lo")).alias("far"),
    )
    near = claims.select(F.col("node").alias("near"), "claim", F.col("n").alias("n_near"))
    far = claims.select(F.col("node").alias("far"), "claim", F.col("n").alias("n_far"))
    return (
        routed.join(near, "near").join(far, ["far", "claim"])
        .groupBy("lo", "hi").agg(F.sum(F.col("n_near") * F.col("n_far")).alias("taken"))
    )


def _log_of_rule(counts: DataFrame, pairs: DataFrame, match_type: str, same_confidence: int) -> DataFrame:
    """Log rows of one rule from ``counts(node, claim, n)`` and similar node pairs ``(lo, hi, confidence)``."""
    sizes = counts.groupBy("node").agg(F.sum("n").alias("n"))
    within = _pairs_within(counts, ["node"]).select(
        F.col("node").alias("lo"), F.col("node").alias("hi"), F.lit(same_confidence).alias("confidence"), "pair_count"
    )
    across = (
        pairs.join(sizes.select(F.col("node").alias("lo"), F.col("n").alias("n_lo")), "lo")
        .join(sizes.select(F.col("node").alias("hi"), F.col("n").alias("n_hi")), "hi")
        .join(_claimed_across(pairs, counts), ["lo", "hi"], "left")
        .select("lo", "hi", "confidence",
                (F.col("n_lo") * F.col("n_hi") - F.coalesce("taken", F.lit(0))).alias("pair_count"))
    )
    return within.unionByName(across).filter("pair_count > 0").select(
        F.lit(match_type).alias("match_type"), "confidence",
        F.col("lo").alias("key_1"), F.col("hi").alias("key_2"), "pair_count",
    )


def match_log(leads: DataFrame, threshold: int = DEFAULT_THRESHOLD) -> DataFrame:
    """Every match by the rule that explains it: ``match_type, confidence, key_1, key_2, pair_count``.

    A key is the email (rule 1), ``domain|name`` (rule 2) or ``name|company`` (rule 3); pair_count says how many
    record pairs the row stands for. This is the full log of matching record pairs, grouped: pairs that an
    earlier rule explains are subtracted, and no record pair is ever produced.
    """
    forms = cut_lineage(
        normal_forms(leads).groupBy("m_email", "m_domain", "m_name", "m_company").agg(F.count(F.lit(1)).alias("n"))
    )
    total = forms.count()
    exact = (
        forms.filter("m_email != ''").groupBy("m_email").agg(F.sum("n").alias("n")).filter("n > 1")
        .select(F.lit(EXACT).alias("match_type"), F.lit(EXACT_CONFIDENCE).alias("confidence"),
                F.col("m_email").alias("key_1"), F.col("m_email").alias("key_2"),
                F.expr("n * (n - 1) div 2").alias("pair_count"))
    )

    key2 = F.concat_ws("|", "m_domain", "m_name")
    counts2 = (
        forms.filter("m_domain != '' and m_name != ''")
        .groupBy(key2.alias("node"), F.col("m_email").alias("claim")).agg(F.sum("n").alias("n"))
    )
    nodes2 = _domain_nodes(forms)
    pairs2 = cut_lineage(similar_pairs(nodes2, nodes2, DOMAIN_NAME_THRESHOLD, total).select(
        F.concat_ws("|", "own_a", F.least("text_a", "text_b")).alias("lo"),
        F.concat_ws("|", "own_a", F.greatest("text_a", "text_b")).alias("hi"),
        F.floor(F.col("score") * 0.9).cast("int").alias("confidence"),
    ))
    domain = _log_of_rule(counts2, pairs2, DOMAIN, SAME_NAME_CONFIDENCE)

    # Similar names in one domain belong to rule 2 and equal emails to rule 1, so rule 3 loses exactly the
    # pairs that share a domain or, where there is no domain, the whole email.
    key3 = F.concat_ws("|", "m_name", "m_company")
    claim3 = F.coalesce(F.nullif(F.col("m_domain"), F.lit("")),
                        F.when(F.col("m_email") != "", F.concat(F.lit(_SEP), F.col("m_email"))))
    counts3 = (
        forms.filter("m_name != '' and m_company != ''")
        .groupBy(key3.alias("node"), claim3.alias("claim")).agg(F.sum("n").alias("n"))
    )
    return exact.unionByName(domain).unionByName(
        _log_of_rule(counts3, _company_node_pairs(forms, total), COMPANY, COMPANY_CONFIDENCE)
    ).filter(F.col("confidence") >= threshold)


def _company_node_pairs(forms: DataFrame, total: int) -> DataFrame:
    ends = [F.concat_ws("|", f"name_{i}", f"company_{i}") for i in (1, 2)]
    return cut_lineage(_company_pairs(forms, total).select(
        F.least(*ends).alias("lo"), F.greatest(*ends).alias("hi"), F.lit(COMPANY_CONFIDENCE).alias("confidence"),
    ))


# ----------------------------------------------------------------------------- clusters and golden records

def _star(members: DataFrame, group: str, total: int) -> DataFrame:
    """Connect the anchors of each group to its smallest anchor; groups with one anchor give nothing."""
    pairs = members.filter(F.col(group).isNotNull()).select(group, "anchor").distinct()
    shared = pairs.groupBy(group).agg(
        F.min("anchor").alias("dst"), F.max("anchor").alias("top"), F.count(F.lit(1)).alias("size")
    ).filter("dst < top").drop("top")
    return skew_safe_lookup(pairs, shared, group, "size", total).filter("anchor > dst").select(
        F.col("anchor").alias("src"), "dst"
    )


MEMBER = ("anchor", "n_email", "n_company", "m_domain", "m_name", "m_company")


def members_of(leads: DataFrame, threshold: int = DEFAULT_THRESHOLD) -> DataFrame:
    """The distinct combinations of anchor, nodes and compared texts of the leads that can match anything; stored."""
    # Filtered after it is stored: pushed down, the filter would compute the normal forms a second time.
    return cut_lineage(_with_nodes(leads, threshold).select(*MEMBER).distinct()).filter("anchor is not null")


def match_edges(leads: DataFrame, threshold: int = DEFAULT_THRESHOLD) -> DataFrame:
    """Edges between anchors whose components are the identities."""
    return member_edges(members_of(leads, threshold), threshold)


def member_edges(members: DataFrame, threshold: int = DEFAULT_THRESHOLD, fresh: DataFrame | None = None) -> DataFrame:
    """Edges between the anchors of stored ``members``; with ``fresh``, a part of them, those that this part adds (others may be among
    them). Names of a domain or of similar companies are then compared only with those of nodes that the other members do not have."""
    total = members.count()
    stored = None if fresh is None else cut_lineage(members.subtract(fresh))
    if stored is not None and stored.isEmpty():
        stored = None  # nothing was compared before
    edges = _star(members, "n_email", total)
    if threshold <= SAME_NAME_CONFIDENCE:
        nodes = _domain_nodes(members)
        if stored is None:
            fuzzy = similar_pairs(nodes, nodes, DOMAIN_NAME_THRESHOLD, total)
        else:
            old = _domain_nodes(stored)
            fuzzy = _pairs_with(cut_lineage(nodes.subtract(old)), old, nodes, DOMAIN_NAME_THRESHOLD, total)
        edges = edges.unionByName(
            fuzzy.filter(F.floor(F.col("score") * 0.9) >= threshold)
            .select(F.concat_ws(_SEP, F.lit("d"), "own_a", "text_a").alias("src"),
                    F.concat_ws(_SEP, F.lit("d"), "own_b", "text_b").alias("dst"))
        )
    if threshold <= COMPANY_CONFIDENCE:
        if stored is not None:
            members = cut_lineage(_near_companies(members, fresh, total))
        anchor_of = members.filter("n_company is not null").groupBy("n_company").agg(F.min("anchor").alias("anchor"))
        node = lambda i: F.concat_ws(_SEP, F.lit("c"), f"name_{i}", f"company_{i}")
        ends = _company_pairs(members, total, stored).select(node(1).alias("n_1"), node(2).alias("n_2"))
        side = lambda key, name: anchor_of.select(F.col("n_company").alias(key), F.col("anchor").alias(name))
        edges = edges.unionByName(_star(members, "n_company", total)).unionByName(
            ends.join(side("n_1", "src"), "n_1").join(side("n_2", "dst"), "n_2").select("src", "dst")
        )
    return edges


def _near_companies(members: DataFrame, fresh: DataFrame, total: int) -> DataFrame:
    """The members whose company is that of a fresh one or similar to it."""
    companies = lambda df: df.filter("m_company != ''").select(F.lit("").alias("grp"), F.col("m_company").alias("text")).distinct()
    new, known = companies(fresh), companies(members)
    pairs = _pairs_with(new, known.subtract(new), known, COMPANY_THRESHOLD, total)
    near = new.select("text").unionByName(pairs.select(F.explode(F.array("text_a", "text_b")).alias("text"))).distinct()
    return members.join(near.withColumnRenamed("text", "m_company"), "m_company", "left_semi")


def cluster_labels(leads: DataFrame, threshold: int = DEFAULT_THRESHOLD) -> DataFrame:
    """``(id, component)`` for the anchors that are linked to another anchor."""
    return connected_components(match_edges(leads, threshold))


def _ranked(field: str) -> Column:
    """The field behind its rank (score, then lead id, then value), null when not usable."""
    score = F.coalesce(F.nanvl("apollo_score", F.lit(0.0)), F.lit(0.0))
    usable = text.is_usable_number(field) if field in GOLDEN_NUMBERS else text.is_usable(field)
    rank = F.struct((-score).alias("rank"), F.coalesce("lead_id", F.lit("")).alias("lead_id"), F.col(field).alias("value"))
    return F.when(usable, rank)


def golden_records(leads: DataFrame, labels: DataFrame | None = None, threshold: int = DEFAULT_THRESHOLD) -> DataFrame:
    """One row per identity with the first usable value of every field, best score first.

    Records collapse to their anchor before labels are joined, so the join sees unique keys on both sides and
    hot anchors are absorbed by map-side aggregation. ``collect_set`` holds combinations of source names only.
    """
    missing = {"apollo_score": "double", "lead_status": "string"}
    leads = leads.withColumns({c: F.lit(None).cast(t) for c, t in missing.items() if c not in leads.columns})
    if labels is None:
        labels = cluster_labels(leads, threshold)
    source = F.coalesce("source", F.lit(text.UNKNOWN))
    ranked = _with_nodes(leads, threshold).select(
        "anchor", source.alias("source"), *[_ranked(f).alias(f) for f in GOLDEN_FIELDS]
    )
    best = [F.min(f).alias(f) for f in GOLDEN_FIELDS]
    by_anchor = ranked.filter("anchor is not null").groupBy("anchor").agg(
        *best, F.array_sort(F.collect_set("source")).alias("sources"), F.count(F.lit(1)).alias("record_count")
    )
    linked = (
        by_anchor.join(labels.withColumnRenamed("id", "anchor"), "anchor", "left")
        .groupBy(F.coalesce("component", "anchor").alias("component"))
        .agg(*best, F.array_sort(F.array_distinct(F.flatten(F.collect_set("sources")))).alias("sources"),
             F.sum("record_count").alias("record_count"))
        .drop("component")
    )
    alone = ranked.filter("anchor is null").select(
        *GOLDEN_FIELDS, F.array("source").alias("sources"), F.lit(1).cast("bigint").alias("record_count")
    )
    value = lambda field: F.col(field)["value"]
    email = F.coalesce(value("email"), F.lit(""))
    return linked.unionByName(alone).select(
        text.global_id(email, value("email_domain")).alias("global_id"),
        *[(email if f == "email" else value(f)).alias(f) for f in GOLDEN_FIELDS],
        F.array_join("sources", ",").alias("sources"),
        F.size("sources").alias("source_count"),
        "record_count",
    )


def resolve(leads: DataFrame, threshold: int = DEFAULT_THRESHOLD) -> DataFrame:
    """Golden records with the time of resolution."""
    return golden_records(leads, threshold=threshold).withColumn("resolved_at", F.current_timestamp())


def multi_source(golden: DataFrame) -> DataFrame:
    return golden.filter("source_count > 1")


def resolution_stats(golden: DataFrame) -> DataFrame:
    """Records in, identities out, merged records, identities seen in several sources, reduction in percent."""
    return golden.agg(
        F.coalesce(F.sum("record_count"), F.lit(0)).alias("input_records"),
        F.count(F.lit(1)).alias("golden_records"),
        F.count_if(F.col("source_count") > 1).alias("multi_source_ids"),
    ).select(
        "input_records", "golden_records",
        (F.col("input_records") - F.col("golden_records")).alias("duplicates_merged"),
        "multi_source_ids",
        F.when(F.col("input_records") > 0, F.bround(
            100 * (F.col("input_records") - F.col("golden_records")) / F.col("input_records"), 1
        )).otherwise(0.0).alias("reduction_pct"),
    )

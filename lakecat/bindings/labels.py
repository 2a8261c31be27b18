"""Domain labels: first match and scores over whole texts and over catalog names."""

from __future__ import annotations

from lakecat.bindings import query, table
from lakecat.functions import rules
from lakecat.functions.domains import (
    with_first_match, with_scored_label, with_scored_text)


def rule_values(rule_set: rules.Rules) -> str:
    """(place, domain, word) rows of a rule set, as SQL."""
    rows = [f"({place}, '{domain}', '{word}')" for place, (domain, words) in enumerate(rule_set.items())
            for word in words]
    return f"(VALUES {', '.join(rows)}) AS r(place, domain, word)"


def _first_match_sql(rule_set: rules.Rules) -> str:
    return f"""
    SELECT d.doc_id, coalesce(m.domain, 'general') AS domain FROM documents d LEFT JOIN (
        SELECT doc_id, arg_min(domain, place) AS domain
        FROM documents JOIN {rule_values(rule_set)} ON contains(lower(text), word) GROUP BY doc_id) m
    ON d.doc_id = m.doc_id"""


def _register_first_match(name: str, rule_set: rules.Rules) -> None:
    @query(name, _first_match_sql(rule_set))
    def label(spark, folder):
        documents = table(spark, folder, "documents").select("doc_id", "text")
        return with_first_match(documents, "text", rule_set).select("doc_id", "domain")


_register_first_match("l_first_match_questions", rules.QUESTION_RULES)
_register_first_match("l_first_match_full", rules.FULL_RULES)
_register_first_match("l_first_match_typed", rules.TYPED_RULES)
_register_first_match("l_first_match_smoke", rules.SMOKE_RULES)


@query("l_scored_text", f"""
    SELECT d.doc_id, coalesce(m.domain, 'general') AS domain, coalesce(m.score, 0) AS score
    FROM documents d LEFT JOIN (
        SELECT doc_id, domain, score FROM (
            SELECT doc_id, domain, place, 10 * count(*) AS score
            FROM documents JOIN {rule_values(rules.SCORED_KEYWORDS)} ON contains(lower(text), word)
            GROUP BY doc_id, domain, place)
        QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, place) = 1) m
    ON d.doc_id = m.doc_id""")
def l_scored_text(spark, folder):
    documents = table(spark, folder, "documents").select("doc_id", "text")
    return with_scored_text(documents, "text").select("doc_id", "domain", "score")


@query("l_scored_urls", f"""
    SELECT d.page_id, coalesce(m.domain, 'general') AS domain, coalesce(m.score, 0) AS score
    FROM pages d LEFT JOIN (
        SELECT page_id, domain, score FROM (
            SELECT page_id, domain, place, 10 * count(*) AS score
            FROM pages JOIN {rule_values(rules.SCORED_KEYWORDS)} ON contains(lower(url), word)
            GROUP BY page_id, domain, place)
        QUALIFY row_number() OVER (PARTITION BY page_id ORDER BY score DESC, place) = 1) m
    ON d.page_id = m.page_id""")
def l_scored_urls(spark, folder):
    pages = table(spark, folder, "pages").select("page_id", "url")
    return with_scored_label(pages, "url").select("page_id", "domain", "score")


@query("l_first_match_names", f"""
    SELECT d.p_partkey, coalesce(m.domain, 'general') AS domain FROM part d LEFT JOIN (
        SELECT p_partkey, arg_min(domain, place) AS domain
        FROM part JOIN {rule_values(rules.FULL_RULES)} ON contains(lower(p_name || '_' || p_type), word)
        GROUP BY p_partkey) m
    ON d.p_partkey = m.p_partkey""")
def l_first_match_names(spark, folder):
    names = table(spark, folder, "part").selectExpr("p_partkey", "concat_ws('_', p_name, p_type) AS name")
    return with_first_match(names, "name", rules.FULL_RULES).select("p_partkey", "domain")

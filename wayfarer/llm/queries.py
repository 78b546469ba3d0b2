"""Registered queries of the training-data operators: each applies its operator, with its
production parameters, to its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from wayfarer.llm import decontam, line_dedup, lm_scoring, merkle, mixing, piece_bpe, quality_lines, simhash_vptree, spelling, substring_dedup, toxicity, url_filter, warc
from wayfarer.llm.common import read


def op1_simhash_vptree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_vptree.near_duplicates(read(spark, sf_dir, "documents"), shingle=3, max_bits=2)


def op2_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scoring.score_documents(read(spark, sf_dir, "documents"))


def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = url_filter.judge(read(spark, sf_dir, "pages").select("page_id", "url"), url_filter.RULES)
    return judged.select("page.page_id", "url_rule.*")


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_lines.quality_report(read(spark, sf_dir, "documents"))


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.leaks(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op6_warc_derivatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.derive(warc.responses(read(spark, sf_dir, "pages")))


def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.duplicate_passages(read(spark, sf_dir, "documents"))


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return line_dedup.dedup_lines(docs).select("doc.doc_id", "line_dedup.*")


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score_documents(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.manifest(read(spark, sf_dir, "documents"))


def op11_piece_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return piece_bpe.digests(read(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def op12_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(read(spark, sf_dir, "documents"))


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.verify_documents(read(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_simhash_vptree": op1_simhash_vptree,
    "op2_lm_scoring": op2_lm_scoring,
    "op3_url_filter": op3_url_filter,
    "op4_quality_rules": op4_quality_rules,
    "op5_decontamination": op5_decontamination,
    "op6_warc_derivatives": op6_warc_derivatives,
    "op7_substring_dedup": op7_substring_dedup,
    "op8_line_dedup": op8_line_dedup,
    "op9_toxicity": op9_toxicity,
    "op10_mixing": op10_mixing,
    "op11_piece_bpe": op11_piece_bpe,
    "op12_spelling": op12_spelling,
    "op13_merkle_manifest": op13_merkle_manifest,
}

ORACLE_SQL: dict[str, str] = {
    "op12_spelling": spelling.ORACLE_SQL,
    "op13_merkle_manifest": merkle.ORACLE_SQL,
    "op3_url_filter": """
with u as (select page_id, case when contains(url, '://') then substr(url, strpos(url, '://') + 3) else '' end as rest
           from pages),
s as (select page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
             regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) as path from u),
rules(rhost, rpath, verdict) as (values ('net', '/', 'block'), ('example.net', '/en/', 'allow'),
                                        ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')),
hit as (select page_id, max_by(rhost || rpath, length(rhost || rpath)) as rule, max_by(verdict, length(rhost || rpath)) as verdict
        from s join rules on (host = rhost or ends_with(host, '.' || rhost)) and starts_with(path, rpath) group by page_id)
select s.page_id, host, path, rule, coalesce(verdict, 'allow') as verdict from s left join hit using (page_id)""",
    "op8_line_dedup": """
with d as (select row_number() over () as rid, doc_id, source, text, string_split(coalesce(text, ''), chr(10)) as lines from documents),
l as (select rid, doc_id, source, text is null as missing, i, lines[i] as raw,
             trim(translate(lines[i], 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) as line
      from (select *, unnest(range(1, len(lines) + 1)) as i from d)),
common as (select line from l where line <> '' group by line having count(distinct coalesce(source, chr(1))) >= 10),
c as (select l.*, line in (select line from common) as cut, trim(raw, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) as body from l),
s as (select rid, sum(case when cut then length(body) else 0 end) <= 0.5 * sum(length(raw)) as good from c group by rid)
select doc_id, count(*) filter (line <> '') as n_lines, count(*) filter (cut and good) as n_removed,
       case when not bool_or(missing) then coalesce(string_agg(raw, chr(10) order by i) filter (not (cut and good)), '') end as text
from c join s using (rid) group by rid, doc_id""",
}

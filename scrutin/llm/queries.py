"""The registered queries of these operators, and the SQL that some of them equal."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from scrutin.llm import decontaminate, hard_negatives, html_text, licenses, lm_score, merkle, ngram_join, packing, quality, suffix_dedup, token_counts, token_files, toxicity
from scrutin.llm.tables import read

Query = Callable[[SparkSession, str], DataFrame]


def fold(folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``."""
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % folds


def ngram_jaccard(spark: SparkSession, folder: str) -> DataFrame:
    return ngram_join.jaccard_groups(read(spark, folder, "documents"), n=4, percent=85)


def token_count(spark: SparkSession, folder: str) -> DataFrame:
    counted = token_counts.count_tokens(read(spark, folder, "documents").select("doc_id", "text"))
    return counted.select("doc_id", "n_bytes", "n_tokens", "over_limit")


def language_model(spark: SparkSession, folder: str) -> DataFrame:
    return lm_score.score(read(spark, folder, "documents"))


def best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(read(spark, folder, "documents"))


def token_sequences(spark: SparkSession, folder: str) -> DataFrame:
    return token_files.token_files(read(spark, folder, "documents"))


def license_scan(spark: SparkSession, folder: str) -> DataFrame:
    found = licenses.scan(read(spark, folder, "documents"))
    return found.select("doc_id", "license_words", "license_id", "license_notices")


def suffix_array_dedup(spark: SparkSession, folder: str) -> DataFrame:
    left = suffix_dedup.remove_repeats(read(spark, folder, "documents").select("doc_id", "text"))
    return left.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept_bytes", 256).alias("kept_sha256"))


def decontamination(spark: SparkSession, folder: str) -> DataFrame:
    docs = read(spark, folder, "documents").select("doc_id", "text")
    return decontaminate.decontaminate(docs, read(spark, folder, "benchmark")).select(
        "doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"
    )


def toxicity_scores(spark: SparkSession, folder: str) -> DataFrame:
    scored = toxicity.score(read(spark, folder, "documents"), read(spark, folder, "labels"))
    predicted = (F.col("score") >= 0.3).cast("int").alias("predicted")
    return scored.select("doc_id", (fold(4) == 2).alias("held_out"), "score", predicted, "threshold", "toxic")


def quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    return quality.quality_rules(read(spark, folder, "documents").select("doc_id", "text")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


def html_extraction(spark: SparkSession, folder: str) -> DataFrame:
    """Main text of all pages."""
    found = html_text.main_text(read(spark, folder, "pages").select("page_id", "url", "html"))
    return found.select("page_id", "url", "text", "n_chars")


def merkle_manifest(spark: SparkSession, folder: str) -> DataFrame:
    """Proofs of all documents; where crc32 of the id is even, of the text without its line feeds."""
    even = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    damaged = F.when(even, F.replace("text", F.lit("\n"), F.lit(""))).otherwise(F.col("text"))
    docs = read(spark, folder, "documents").select("doc_id", "source", "lang", "n_chars", "text")
    proven = merkle.manifest(docs, altered={"text": damaged})
    return proven.select("doc_id", "leaf", "subroot", "root", F.sha2("proof", 256).alias("proof_sha256"), "folded_root", "verified")


def hard_negative_mining(spark: SparkSession, folder: str) -> DataFrame:
    """Negatives for every hundredth vector against all; labels of every seventh are shifted."""
    vectors = read(spark, folder, "embeddings").select("vec_id", "embedding", "label")
    shifted = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(vectors.withColumn("label", shifted), F.col("vec_id") % 100 == 0)


_STOPS = ", ".join(f"'{w}'" for w in quality.STOP_WORDS)
QUALITY_SQL = rf"""
with texts as (
    select doc_id, coalesce(text, '') as t,
           [w for w in regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+') if w <> ''] as ws,
           [l for l in string_split(coalesce(text, ''), chr(10)) if regexp_matches(l, '[^\x20\x09-\x0D]')] as ls
    from documents
), places as (
    select doc_id, ws, unnest(range(1, len(ws) - 1)) as i from texts
), windows as (
    select doc_id, i, count(*) over (partition by doc_id, ws[i], ws[i + 1], ws[i + 2]) as n from places
), repeats as (
    select doc_id, count(distinct p) as n from (
        select doc_id, unnest([i, i + 1, i + 2]) as p from windows where n > 1) group by doc_id
), counted as (
    select d.doc_id, len(ws)::bigint as n_words, length(array_to_string(ws, ''))::bigint as word_chars,
           (length(t) - length(regexp_replace(t, '{quality.SYMBOLS}', '', 'g')))::bigint as n_symbols,
           len(ls)::bigint as n_lines, (len(ls) - len(list_distinct(ls)))::bigint as n_dup_lines,
           coalesce(r.n, 0)::bigint as n_repeat_words,
           len([w for w in ws if lower(w) in ({_STOPS})])::bigint as n_stop_words
    from texts d left join repeats r on r.doc_id = d.doc_id
), judged as (
    select *, n_words < 50 or 100 * n_repeat_words > 50 * n_words as base_failed from counted
)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       coalesce(not base_failed and word_chars / n_words between 1.5 and 25.0 and n_symbols / n_words <= 0.25
                and n_stop_words / n_words >= 0.01 and n_dup_lines / n_lines <= 0.7, false) as kept
from judged
"""

_FIELD = "coalesce(octet_length(encode({0}::varchar))::varchar || ':' || {0}::varchar, '-')"


def _leaf(text: str) -> str:
    return "sha256(" + " || ".join(_FIELD.format(f) for f in ("doc_id", "source", "lang", "n_chars", text)) + ")"


#: The lowest bit of crc32, by its shift register: bytes of the decimal id go in one by one.
_CRC_BIT = """(1 & ~list_reduce(list_prepend(4294967295::bigint, [ascii(d)::bigint for d in string_split(doc_id::varchar, '')]),
    lambda c, b: list_reduce(list_prepend(xor(c, b), [0::bigint, 0, 0, 0, 0, 0, 0, 0]),
        lambda r, z: xor(r >> 1, 3988292384 * (r & 1)))))"""


def _tree(name: str, start: str) -> str:
    return f"""{name}(tree, level, i, n, h) as (
    {start}
    union all
    select tree, level + 1, i // 3, (n + 2) // 3, sha256(string_agg(h, '' order by i)) from {name} where n > 1 group by tree, level, i // 3, n)"""


MERKLE_SQL = f"""
with recursive leaves as (
    select doc_id, coalesce('s' || source, '') as tree, {_leaf("text")} as leaf,
           {_leaf(f"(case when {_CRC_BIT} = 0 then replace(text, chr(10), '') else text end)")} as changed,
           row_number() over (partition by source order by doc_id) - 1 as i, count(*) over (partition by source) as n
    from documents
), {_tree("low", "select tree, 0::bigint, i, n, leaf from leaves")},
subroots as (select tree, h, row_number() over (order by tree) - 1 as i, count(*) over () as n from low where n = 1),
{_tree("high", "select '', 0::bigint, i, n, h from subroots")},
steps as (
    select l.doc_id, s.level, s.i, s.h from leaves l join low s on s.tree = l.tree and s.n > 1
        and s.i // 3 = (l.i // (3 ** s.level)::bigint) // 3 and s.i <> l.i // (3 ** s.level)::bigint
    union all
    select l.doc_id, 1000 + s.level, s.i, s.h from leaves l join subroots r on r.tree = l.tree join high s on s.n > 1
        and s.i // 3 = (r.i // (3 ** s.level)::bigint) // 3 and s.i <> r.i // (3 ** s.level)::bigint
), proofs as (select doc_id, string_agg(h, '' order by level, i) as proof from steps group by doc_id),
folded(doc_id, tree, level, i, n, h) as (
    select doc_id, tree, 0::bigint, i, n, changed from leaves
    union all
    select f.doc_id, f.tree, f.level + 1, f.i // 3, (f.n + 2) // 3, sha256(string_agg(case when s.i = f.i then f.h else s.h end, '' order by s.i))
    from folded f join low s on s.tree = f.tree and s.level = f.level and s.i // 3 = f.i // 3 where f.n > 1
    group by f.doc_id, f.tree, f.level, f.i, f.n
), ends(doc_id, level, i, n, h) as (
    select f.doc_id, 0::bigint, r.i, r.n, f.h from folded f join subroots r on r.tree = f.tree where f.n = 1
    union all
    select f.doc_id, f.level + 1, f.i // 3, (f.n + 2) // 3, sha256(string_agg(case when s.i = f.i then f.h else s.h end, '' order by s.i))
    from ends f join high s on s.level = f.level and s.i // 3 = f.i // 3 where f.n > 1
    group by f.doc_id, f.level, f.i, f.n
)
select l.doc_id, l.leaf, r.h as subroot, t.h as root, sha256(coalesce(p.proof, '')) as proof_sha256, e.h as folded_root, e.h = t.h as verified
from leaves l join subroots r on r.tree = l.tree join (select h from high where n = 1) t on true
left join proofs p on p.doc_id = l.doc_id join ends e on e.doc_id = l.doc_id and e.n = 1
"""

NEGATIVES_SQL = """
with v as (
    select row_number() over () as r, vec_id::bigint as id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
           [floor(256 * x::double)::bigint for x in embedding] as e
    from embeddings where label is not null and embedding is not null and vec_id is not null
      and len([x for x in embedding if x is null or not isfinite(x)]) = 0
), scored as (
    select a.r as ar, a.id as anchor_id, b.r as br, b.id, a.label = b.label as same,
           list_sum([x[1] * x[2] for x in list_zip(a.e, b.e)])::bigint as score
    from v a join v b on a.id % 100 = 0 and a.r <> b.r
), positives as (
    select * from scored where same qualify row_number() over (partition by ar order by score desc, id, br) <= 5
), ranked as (
    select p.anchor_id, p.id as positive_id, n.id as negative_id, p.score as positive_score, n.score as negative_score,
           row_number() over (partition by p.ar, p.br order by n.score desc, n.id, n.br)::int as rank
    from positives p join scored n on n.ar = p.ar and not n.same and 80 * p.score <= 100 * n.score and n.score <= p.score
)
select anchor_id, positive_id, rank, negative_id, positive_score, negative_score from ranked where rank <= 5
"""

QUERIES: dict[str, tuple[Query, str | None]] = {
    "op1_ngram_jaccard_join": (ngram_jaccard, None),
    "op2_token_counts": (token_count, None),
    "op3_lm_score": (language_model, None),
    "op4_best_fit_packing": (best_fit_packing, None),
    "op7_token_files": (token_sequences, None),
    "op5_license_scan": (license_scan, None),
    "op6_toxicity": (toxicity_scores, None),
    "op8_suffix_array_dedup": (suffix_array_dedup, None),
    "op9_benchmark_decontamination": (decontamination, None),
    "op10_quality_rules": (quality_rules, QUALITY_SQL),
    "op11_html_extraction": (html_extraction, None),
    "op12_merkle_manifest": (merkle_manifest, MERKLE_SQL),
    "op13_hard_negative_mining": (hard_negative_mining, NEGATIVES_SQL),
}

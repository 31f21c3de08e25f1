"""The operators as queries over the whole tables, and as SQL where it can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from article_warehouse.llm.clustering import CENTROIDS, LENGTH, ROUNDS, SEED, STEPS, clustered
from article_warehouse.llm.common import table
from article_warehouse.llm.decontaminate import SHINGLE, THRESHOLD, contaminated
from article_warehouse.llm.exact import exact_groups
from article_warehouse.llm.language import identify
from article_warehouse.llm.licenses import BREAK, BREAKS, PHRASES, TEMPLATES, WORD, license_scan, window_length
from article_warehouse.llm.mixing import mix
from article_warehouse.llm.pages import main_text
from article_warehouse.llm.quality import quality_scores
from article_warehouse.llm.recurrent import language_model_scores
from article_warehouse.llm.secrets import secret_digest
from article_warehouse.llm.simhash import near_duplicates
from article_warehouse.llm.tokens import token_counts
from article_warehouse.llm.whitening import whitened


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents"))


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op3_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(table(spark, sf_dir, "documents"), tokenizer_path())


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op4_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_digest(table(spark, sf_dir, "documents"))


def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_groups(table(spark, sf_dir, "documents"))


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


def op7_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan(table(spark, sf_dir, "documents"))


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op9_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_model_scores(table(spark, sf_dir, "documents"))


def op10_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify(table(spark, sf_dir, "documents"))


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitened(table(spark, sf_dir, "embeddings"))


def op12_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clustered(table(spark, sf_dir, "embeddings"))


def op13_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_text(table(spark, sf_dir, "pages"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_mixing": op1_mixing,
        "op2_quality": op2_quality,
        "op3_tokens": op3_tokens,
        "op4_secrets": op4_secrets,
        "op5_exact_dedup": op5_exact_dedup,
        "op6_simhash": op6_simhash,
        "op7_licenses": op7_licenses,
        "op8_decontamination": op8_decontamination,
        "op9_language_model": op9_language_model,
        "op10_language": op10_language,
        "op11_whitening": op11_whitening,
        "op12_clustering": op12_clustering,
        "op13_main_text": op13_main_text,
    }


_EXACT = r"""
with hashed as (
  select doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) as text_sha256 from documents
)
select doc_id, min(doc_id) over same as keep_id, count(*) over same as group_size,
  doc_id = min(doc_id) over same as kept, text_sha256
from hashed window same as (partition by text_sha256)"""


_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _licenses(threshold: float = 0.8) -> str:
    """Every block of a text is compared with every template of which the text has enough words."""

    def places(phrase: str) -> str:
        parts = phrase.split()
        tests = " and ".join(f"w[i + {k}] = '{part}'" for k, part in enumerate(parts))
        return f"[i - 1 for i in range(1, len(w) - {len(parts) - 2}) if {tests}]"

    every = " || ".join(places(phrase) for phrase in PHRASES)
    base = " || ".join(f"(case when len({places(phrase)}) > 0 then ['{label}'] else [] end)" for phrase, label in PHRASES.items())
    wanted = ", ".join(f"('{text}', '{label}', {window_length(len(text.split()), threshold)})" for text, label in TEMPLATES.items())
    return f"""
with words as (
  select doc_id, regexp_extract_all({_LOWER}, '{WORD}') as w,
    regexp_extract_all(regexp_replace({_LOWER}, '{BREAKS}', ' {BREAK} ', 'g'), '{WORD}') as parted
  from documents
),
based as (select doc_id, cast(len(w) as bigint) as n_words, {every} as places, {base} as base from words),
templates as (
  select label, list_distinct(string_split(template, ' ')) as wanted, width from (values {wanted}) as t(template, label, width)
),
possible as (
  select doc_id, parted, label, wanted, width, ceil({threshold} * len(wanted) - 1e-9) as need from words cross join templates
  where len(list_intersect(w, wanted)) >= need
),
shared as (
  select doc_id, label, len(wanted) as size, need,
    list_max([
      len(list_intersect(case when list_position(b, '{BREAK}') > 0 then b[:list_position(b, '{BREAK}') - 1] else b end, wanted))
      for b in [parted[i:i + width - 1] for i in range(1, len(parted) + 1)]
    ]) as shared
  from possible
),
matched as (
  select doc_id, list(distinct label) as labels, max(cast(shared as double) / size) as containment
  from shared where shared >= need group by doc_id
)
select doc_id, n_words, cast(len(places) as bigint) as n_base,
  cast(list_min(places) as bigint) as first_word, cast(list_max(places) as bigint) as last_word,
  coalesce(array_to_string(list_sort(list_distinct(base)), ','), '') as base_labels,
  coalesce(array_to_string(list_sort(list_distinct(base || coalesce(labels, []))), ','), '') as labels,
  case when len(places) > 0 then 1.0::double else coalesce(containment, 0.0)::double end as score
from based left join matched using (doc_id)"""


_CONTAMINATED = f"""
with words as (
  select 'd' as side, doc_id as id, regexp_extract_all(lower(coalesce(text, '')), '{WORD}') as w from documents
  union all select 'b', item_id, regexp_extract_all(lower(coalesce(text, '')), '{WORD}') from benchmark
),
shingles as (
  select distinct side, id, unnest([array_to_string(w[i:i + {SHINGLE - 1}], ' ') for i in range(1, len(w) - {SHINGLE - 2})]) as shingle
  from words
),
items as (select id, count(*) as n from shingles where side = 'b' group by id),
shared as (
  select d.id as doc_id, b.id as item_id, count(*) as n
  from shingles d join shingles b on d.shingle = b.shingle and d.side = 'd' and b.side = 'b' group by all
)
select doc_id, item_id, cast(i.n as integer) as n_shingles, cast(s.n as integer) as n_shared, s.n / i.n as containment
from shared s join items i on i.id = item_id where s.n >= ceil({THRESHOLD} * i.n - 1e-9)"""


def _clusters() -> str:
    """Every vector is compared with every centroid, entry by entry, in each round."""

    def assigned(round_: int) -> str:
        return f"""
assigned{round_} as (
  select vec_id, arg_min(cluster, (distance, cluster)) as cluster, min(distance) as distance
  from (
    select p.vec_id, c.cluster, sum((p.x - c.x) * (p.x - c.x)) as distance
    from entries p join centroids{round_} c using (i) group by p.vec_id, c.cluster
  ) group by vec_id
)"""

    def moved(round_: int) -> str:
        return f"""
centroids{round_ + 1} as (
  select cluster, i, coalesce((total - ((total % n) + n) % n) // n, x) as x
  from centroids{round_} left join (
    select cluster, i, sum(x) as total, count(*) as n from entries join assigned{round_} using (vec_id) group by cluster, i
  ) using (cluster, i)
)"""

    steps = ",".join(f"{assigned(k)},{moved(k)}" for k in range(ROUNDS))
    valid = f"len(embedding) = {LENGTH} and len([c for c in embedding if isfinite(c)]) = {LENGTH}"
    return f"""
with kept as (
  select vec_id, [cast(floor({STEPS} * cast(c as double)) as bigint) for c in embedding] as point
  from embeddings where {valid}
),
entries as materialized (select vec_id, unnest(range(1, {LENGTH + 1})) as i, cast(unnest(point) as hugeint) as x from kept),
first as (
  select row_number() over (order by sha256('{SEED}:' || vec_id)) - 1 as cluster, point from kept
  order by sha256('{SEED}:' || vec_id) limit {CENTROIDS}
),
centroids0 as (select cluster, unnest(range(1, {LENGTH + 1})) as i, cast(unnest(point) as hugeint) as x from first),
{steps},{assigned(ROUNDS)},
digests as (
  select cluster, sha256(string_agg(cast(x as varchar), ',' order by i)) as centroid_sha256 from centroids{ROUNDS} group by cluster
)
select vec_id, cast(cluster as integer) as cluster, cast(distance as bigint) as distance,
  cast(sum(distance) over (partition by cluster) as bigint) as cluster_inertia, cast(sum(distance) over () as bigint) as inertia,
  centroid_sha256
from assigned{ROUNDS} join digests using (cluster)"""


def oracle_sql() -> dict[str, str]:
    return {"op5_exact_dedup": _EXACT, "op7_licenses": _licenses(), "op8_decontamination": _CONTAMINATED, "op12_clustering": _clusters()}

"""The registered queries of this package and the SQL they are checked against."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.ann import nearest
from millrace.llm.exact_dedup import exact_groups
from millrace.llm.language_id import identify, page_evidence, train_text_model
from millrace.llm.lexical import search
from millrace.llm.line_dedup import drop_repeated_lines
from millrace.llm.mixing import cyclic_weights, mix, word_count
from millrace.llm.ngram_join import ngram_components
from millrace.llm.packing import pack
from millrace.llm.shared import table
from millrace.llm.simhash import near_duplicates
from millrace.llm.token_counts import token_counts
from millrace.llm.toxicity import score, train
from millrace.llm.vector_codes import compress
from millrace.llm.warc import archived_pages
from millrace.workload.registry import Query, Run

LLM_QUERIES: dict[str, Query] = {}

TOKEN_LIMIT = 1024


def _query(oracle: str | None = None):
    def register(run: Run) -> Run:
        LLM_QUERIES[run.__name__] = Query(run.__name__, run, oracle)
        return run

    return register


def _lower_sql(text: str) -> str:
    return f"""translate({text}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"""


@_query(f"""
with lines as (
  select doc_id, unnest(string_split(coalesce(text, ''), chr(10))) as line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) as pos
  from documents),
keyed as (
  select *, {_lower_sql(r"regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g')")} as key
  from lines),
repeated as (
  select key, max(doc_id) as largest from keyed where length(key) >= 20
  group by key having count(distinct doc_id) >= 3),
marked as (
  select k.*, coalesce(k.doc_id <> r.largest, false) as gone
  from keyed k left join repeated r using (key))
select doc_id, count(*) as n_lines, count(*) filter (gone) as n_dropped,
       sha256(coalesce(string_agg(line, chr(10) order by pos) filter (not gone), '')) as kept_sha256
from marked group by doc_id""")
def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = drop_repeated_lines(table(spark, sf_dir, "documents"))
    return kept.select(
        "doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256")
    )


@_query(f"""
with t as (select doc_id, {_lower_sql("coalesce(text, '')")} as folded from documents)
select doc_id, max(doc_id) over same as keep_id, count(*) over same as group_size,
       doc_id = max(doc_id) over same as kept, sha256(folded) as text_sha256
from t window same as (partition by folded)""")
def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_groups(table(spark, sf_dir, "documents"))


@_query(r"""
with sized as (
  select doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) as size,
         (cast('0x' || substr(md5('7:' || doc_id), 1, 13) as bigint) + 0.5::double)
           / 4503599627370496.0::double as random,
         case when size >= 50 then 2.0::double else 1.0::double end as wish
  from documents),
summed as (select source, sum(size)::bigint as source_size from sized group by source),
weighed as (
  select *, [1.0::double, 2.0::double, 3.0::double]
              [(row_number() over (order by source nulls last) - 1) % 3 + 1] as weight,
         row_number() over (order by source nulls last) as place,
         3 * source_size::double as filled
  from summed),
levelled as (
  select *, (sum(source_size) over () - coalesce(sum(filled) over ahead, 0.0::double))
            / (sum(weight) over () - coalesce(sum(weight) over ahead, 0.0::double)) as level
  from weighed
  window ahead as (order by filled / weight, place
                   rows between unbounded preceding and 1 preceding)),
aimed as (
  select source, source_size, least(filled, max(level) over () * weight) as target
  from levelled),
per_level as (
  select source, wish, sum(size) as level_size, sum(size * wish) as liked from sized group by source, wish),
shared as (
  select source, 3 * coalesce(sum(level_size) over (partition by source order by wish desc
                    rows between unbounded preceding and 1 preceding), 0)::double as full_size,
         sum(liked) over (partition by source order by wish
                    rows between unbounded preceding and current row) as open
  from per_level),
factors as (
  select a.source, a.source_size, a.target,
         greatest(coalesce(max(case when open > 0 then (target - full_size) / open end), 0.0::double), 0.0::double) as factor
  from aimed a join shared s on s.source is not distinct from a.source group by all),
wanted as (
  select s.*, a.source_size, a.target, least(factor * wish, 3.0::double) as copies
  from sized s join factors a on s.source is not distinct from a.source),
ranked as (
  select *, floor(copies) as certain, copies - floor(copies) as p,
         (random / (1 - random)) / ((copies - floor(copies)) / (1 - (copies - floor(copies)))) as ratio
  from wanted),
summing as (
  select *, target - sum(size * certain) over (partition by source) as room,
         sum(size) over (partition by source
                         order by case when p > 0 and size > 0 then ratio / (1 + ratio) else 2 end,
                                  doc_id, size
                         rows between unbounded preceding and current row) as upto
  from ranked)
select doc_id, size::bigint as size, source_size, target,
       (size * (certain + case when p > 0 and size > 0 and upto - size / 2.0 <= room
                               then 1 else 0 end))::bigint as taken,
       (certain + case when p > 0 and size > 0 and upto - size / 2.0 <= room
                       then 1 else 0 end)::bigint as copies
from summing""")
def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts of 50 words and more are wanted twice as often as shorter ones."""
    docs = table(spark, sf_dir, "documents")
    wish = F.when(word_count(F.col("text")) >= 50, F.lit(2.0)).otherwise(F.lit(1.0))
    return mix(docs.withColumn("wish", wish), cyclic_weights(1, 2, 3), weight_col="wish")


@_query()
def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = train_text_model(table(spark, sf_dir, "documents"))
    pages = page_evidence(table(spark, sf_dir, "pages"), "page_id", "url", "html")
    return identify(pages, model).withColumnRenamed("id", "page_id")


@_query()
def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(
        table(spark, sf_dir, "documents"),
        public_tokenizers.path("word_bpe_49k.json"),
        end_id=2,
    )


@_query("""
with usable as (
  select vec_id, embedding::double[] as v from embeddings
  where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
    and len(list_filter(embedding, lambda x: x <> 0)) > 0),
scored as (
  select q.vec_id as query_id, c.vec_id, list_dot_product(c.v, q.v) as score
  from usable q join usable c on q.vec_id <> c.vec_id where q.vec_id % 20 = 0),
ranked as (
  select *, row_number() over (partition by query_id order by score desc, vec_id) as rank
  from scored)
select query_id, rank::integer as rank, vec_id, score from ranked where rank <= 20""")
def op6_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


@_query()
def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = token_counts(
        table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json")
    )
    return counts.withColumn("over_limit", F.col("n_tokens") > TOKEN_LIMIT)


@_query("""
with payloads as (
  select page_id, coalesce(html, '') as payload, sha1(coalesce(html, '')) as digest from pages),
grouped as (select *, max(page_id) over (partition by payload) as first from payloads)
select page_id, strlen(payload)::bigint as payload_bytes,
  list_aggregate(list_transform(range(0, 32), lambda k: substr(
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    ((cast('0x' || substr(digest, 5 * (k // 4) + 1, 5) as integer) >> (15 - 5 * (k % 4))) & 31) + 1,
    1)), 'string_agg', '') as payload_digest,
  case when page_id = first then 'response' else 'revisit' end as record_type,
  case when page_id <> first then first end as refers_to
from grouped""")
def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return archived_pages(table(spark, sf_dir, "pages"))


@_query()
def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    labels = table(spark, sf_dir, "labels").filter(~held_out).select("doc_id", "toxic")
    scored = score(docs, train(docs, labels))
    return scored.select(
        "doc_id",
        F.coalesce(held_out, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


@_query()
def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


def _round_sql(n: int) -> str:
    """Assign the parts to entries ``e{n}`` as ``a{n}`` and, but for the last, move the entries."""
    assign = f"""
a{n} as materialized (
  select vec_id, p, min([d, e])[1] as d, min([d, e])[2] as e from (
    select vec_id, p, e, list_sum(list_transform(list_zip(part, entry),
             lambda z: (z[1] - z[2]) * (z[1] - z[2])))::bigint as d
    from parts join e{n} using (p))
  group by vec_id, p)"""
    move = f""",
m{n} as (
  select p, e, list(c order by pos) as entry from (
    select p, e, pos, floor(sum(x)::double / count(*))::bigint as c from (
      select p, e, unnest(part) as x, generate_subscripts(part, 1) as pos
      from a{n} join parts using (vec_id, p))
    group by p, e, pos)
  group by p, e),
e{n + 1} as materialized (
  select p, e, coalesce(m{n}.entry, e{n}.entry) as entry from e{n} left join m{n} using (p, e))"""
    return assign + move if n < 2 else assign


@_query(f"""
with kept as (
  select vec_id, label, list_transform(embedding, lambda x: floor(256 * x::double)::bigint) as v
  from embeddings where embedding is not null
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
parts as materialized (
  select vec_id, p, v[(p * len(v) // 16 + 1):((p + 1) * len(v) // 16)] as part
  from kept, range(16) as positions(p)),
e0 as materialized (
  select p, row_number() over (partition by p order by vec_id) - 1 as e, part as entry
  from parts qualify e < 64),
{_round_sql(0)},
{_round_sql(1)},
{_round_sql(2)},
coded as (
  select vec_id, string_agg(printf('%02x', e), '' order by p) as code, sum(d)::bigint as error
  from a2 group by vec_id)
select vec_id, label, code, error, (sum(error) over (partition by label))::bigint as label_error,
       (select sha256(string_agg(array_to_string(entry, ','), ',' order by p, e)) from e2)
         as codebooks_sha256
from coded join kept using (vec_id)""")
def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compress(table(spark, sf_dir, "embeddings"))


@_query()
def op12_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_components(table(spark, sf_dir, "documents"))


def _terms_sql(source: str, name: str) -> str:
    return f"""
  select {name}, unnest(regexp_extract_all({_lower_sql("text")},
           '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as term
  from {source} where text is not null"""


@_query(f"""
with found as ({_terms_sql("documents", "doc_id")}),
asked as (select item_id, term, count(*) as q from ({_terms_sql("benchmark", "item_id")})
          group by item_id, term),
lengths as (select doc_id, count(*) as n from found group by doc_id),
whole as (select count(*) as docs, sum(n)::bigint as words from lengths),
held as (select doc_id, term, count(*) as tf from found semi join asked using (term)
         group by doc_id, term),
weights as (
  select term, floor(1000 * ln((2 * any_value(docs) + 2)::double / (2 * count(*) + 1)::double))::bigint as w
  from held, whole group by term),
norms as (select doc_id, 25 + (75 * n * docs) // words as m from lengths, whole),
scores as (
  select item_id, doc_id,
         sum(q * w * ((1000000000 * tf) // (1000 * tf + 8 * m)))::bigint as score
  from asked join held using (term) join weights using (term) join norms using (doc_id)
  group by item_id, doc_id)
select item_id, (row_number() over best)::integer as rank, doc_id, score
from scores where score > 0
window best as (partition by item_id order by score desc, doc_id)
qualify rank <= 10""")
def op13_lexical(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))

"""One query per corpus operator over the supplied tables, with the SQL that must give the same rows where SQL can."""

from pyspark.sql import functions as F

from gavelline.llm import (
    bfd_packing, fingerprints, langid, licences, line_dedup, mix_packing, mixing, quality, sharding, simhash, spelling, toxicity,
    whitening,
)
from gavelline.llm.common import table, whole

WORDS_SQL = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"


def op1_line_dedup(spark, sf_dir):
    """All documents without the lines that five documents or more share, but for the last of these."""
    documents = table(spark, sf_dir, "documents")
    cleaned = line_dedup.LineStore.of(documents).clean(documents, own=True)
    kept = F.sha2(whole(F.col("_kept")).cast("binary"), 256).alias("kept_sha256")
    return cleaned.select("doc_id", F.col("_n_lines").alias("n_lines"), F.col("_n_dropped").alias("n_dropped"), kept)


OP1_SQL = r"""
with lines as (
  select doc_id, unnest(string_split(coalesce(text, ''), chr(10))) as line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) as place
  from documents),
keyed as (
  select *, translate(regexp_replace(regexp_replace(line, '^[\x20\x09-\x0D]+', ''), '[\x20\x09-\x0D]+$', ''),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as key
  from lines),
shared as (
  select key, max(doc_id) as keeper from keyed where length(key) >= 40 group by key having count(distinct doc_id) >= 5),
marked as (
  select k.*, s.key is not null and k.doc_id <> s.keeper as gone from keyed k left join shared s on s.key = k.key)
select doc_id, count(*) as n_lines, count(*) filter (gone) as n_dropped,
       sha256(coalesce(string_agg(line, chr(10) order by place) filter (not gone), '')) as kept_sha256
from marked group by doc_id
"""


def op2_minimax_sharding(spark, sf_dir):
    """All documents in 24 shards of near equal bytes; equal texts stay together."""
    sharded = sharding.shard_documents(table(spark, sf_dir, "documents"), 24)
    return sharded.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op3_weighted_fingerprints(spark, sf_dir):
    """All documents with the fingerprints of their texts and of their edited texts."""
    return fingerprints.with_next(table(spark, sf_dir, "documents"))


def op4_mixture_packing(spark, sf_dir):
    """All documents in sequences of 2048 tokens, each near the sources' shares of all tokens."""
    return mix_packing.pack(table(spark, sf_dir, "documents"))


def op5_quality_rules(spark, sf_dir):
    """All documents with their statistics and the verdict of base rules and boosted trees."""
    ruled = quality.rules(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return ruled.select("doc_id", *quality.BASE, "base_failed", "kept", "score")


def op6_simhash_near_dedup(spark, sf_dir):
    """All documents with their fingerprint and the class of near copies they belong to."""
    return simhash.near_duplicates(table(spark, sf_dir, "documents"), 4, 4)


def op7_source_mixing(spark, sf_dir):
    """All documents, each with the words that the mix of sources takes from it."""
    mixed = mixing.mixed_sizes(table(spark, sf_dir, "documents"))
    taken = (F.col("size") * F.col("n_copies")).alias("taken")
    return mixed.select("doc_id", "size", "source_size", "target", taken)


OP7_SQL = f"""
with sized as (
  select doc_id, source, cast(len({WORDS_SQL}) as bigint) as size,
         coalesce(cast(doc_id as varchar), '') || ':' || md5(coalesce(text, '')) as identity from documents),
totals as (
  select source, cast(sum(size) as bigint) as source_size,
         (row_number() over (order by source nulls last) - 1) % 3 + 1 as weight
  from sized group by source),
capped as (
  select *, 3 * source_size as cap, cast(3 * source_size as double) / weight as most from totals),
shares as (
  select *, ((select sum(source_size) from totals)
             - coalesce(sum(cap) over (order by most, weight, source rows between unbounded preceding and 1 preceding), 0))
            / cast(sum(weight) over (order by most, weight, source rows between current row and unbounded following)
                   as double) as share
  from capped),
targets as (select source, source_size, least(cap, (select max(share) from shares) * weight) as target from shares),
rates as (
  select *, case when source_size > 0 then target / source_size else 1 end as rate from targets)
select doc_id, size, source_size, target,
       cast(size * (floor(rate) + case when
         cast('0x' || substr(md5('mix:' || identity), 1, 12) as bigint) / 281474976710656.0
         < rate - floor(rate) then 1 else 0 end) as bigint) as taken
from sized join rates on sized.source is not distinct from rates.source
"""

def op8_bfd_packing(spark, sf_dir):
    """All documents as packed rows of token ids."""
    return bfd_packing.pack(table(spark, sf_dir, "documents"))


def op9_toxicity(spark, sf_dir):
    """All documents with the score of a model that has not seen the labels of a fifth of the ids."""
    documents, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit(False))
    model = toxicity.fitted(documents, labels.filter(~held_out))
    predicted = (F.col("score") >= 0.5).cast("int").alias("predicted")
    return toxicity.scored(documents, model).select("doc_id", held_out.alias("held_out"), "score", predicted)


def op10_licence_scan(spark, sf_dir):
    """The licences of all documents."""
    return licences.scan(table(spark, sf_dir, "documents"))


def op11_spelling_variants(spark, sf_dir):
    """All words of all documents with their near words and the form they are a variant of."""
    return spelling.variants(table(spark, sf_dir, "documents"))


def _crc_table():
    """The 256 remainders of the reflected polynomial 0xEDB88320."""
    for value in range(256):
        for _ in range(8):
            value = value >> 1 ^ (0xEDB88320 if value & 1 else 0)
        yield value


# Near words share what is left without one code point: at the same place, or one of them is what is left of the other.
OP11_SQL = f"""
with recursive runs as (
  select id, run, count(*) as k from (
    select coalesce(cast(doc_id as varchar), '') as id,
           translate(unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-zÀ-ÿ]{{7,}}')),
                     'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as run
    from documents) group by all),
points as (select *, list_transform(string_split(id || ':' || run, ''), lambda c: cast(unicode(c) as bigint)) as p from runs),
hashed as (
  select *, xor(list_reduce(list_prepend(4294967295, flatten(list_transform(p, lambda x:
           case when x < 128 then [x] else [192 + x // 64, 128 + x % 64] end))),
           lambda c, b: xor(c // 256, [{", ".join(f"{v}::bigint" for v in _crc_table())}][xor(c, b) % 256 + 1])), 4294967295) as h
  from points),
words as (
  select word, cast(sum(k) as bigint) as n from (
    select k, case when h % 31 = 0 then left(run, h % length(run)) || substr(run, h % length(run) + 2) else run end as word
    from hashed) where length(word) >= 7 group by word having sum(k) >= 2),
lacking as (
  select word, place, left(word, place - 1) || substr(word, place + 1) as rest
  from (select word, unnest(range(1, length(word) + 1)) as place from words)),
near as (
  select a.word, b.word as other from lacking a join lacking b on a.rest = b.rest and a.place = b.place and a.word <> b.word
  union select l.word, w.word from lacking l join words w on l.rest = w.word
  union select w.word, l.word from lacking l join words w on l.rest = w.word),
best as (
  select near.word, count(*) as n_near, min({{'below': -o.n, 'word': near.other}}) as found
  from near join words o on o.word = near.other group by near.word),
formed as (
  select w.word, w.n, coalesce(n_near, 0) as n_near, case when -found.below >= 10 * w.n then found.word end as form,
         case when -found.below >= 10 * w.n then -found.below end as form_n
  from words w left join best using (word)),
chains as (
  select word, form as at from formed where form is not null
  union all select c.word, f.form from chains c join formed f on f.word = c.at where f.form is not null),
ends as (select c.word, c.at from chains c join formed f on f.word = c.at where f.form is null)
select word, form, coalesce(ends.at, word) as root, n, n_near, form_n from formed left join ends using (word)
"""


def op12_language_id(spark, sf_dir):
    """The language of all documents by a model that has not seen a fifth of the ids."""
    documents = table(spark, sf_dir, "documents")
    bucket = F.crc32(F.col("doc_id").cast("string")) % 5
    model = langid.fitted(documents, bucket != 0)
    held_out = F.coalesce(bucket == 0, F.lit(False)).alias("held_out")
    return langid.labelled(documents, model).select("doc_id", held_out, "lang_pred", "score")


def op13_embedding_whitening(spark, sf_dir):
    """All usable vectors in coordinates of variance one along the first components."""
    return whitening.whitened(table(spark, sf_dir, "embeddings"))


#: name -> (query, SQL or None)
QUERIES = {
    "op1_line_dedup": (op1_line_dedup, OP1_SQL),
    "op2_minimax_sharding": (op2_minimax_sharding, None),
    "op3_weighted_fingerprints": (op3_weighted_fingerprints, None),
    "op4_mixture_packing": (op4_mixture_packing, None),
    "op5_quality_rules": (op5_quality_rules, None),
    "op6_simhash_near_dedup": (op6_simhash_near_dedup, None),
    "op7_source_mixing": (op7_source_mixing, OP7_SQL),
    "op8_bfd_packing": (op8_bfd_packing, None),
    "op9_toxicity": (op9_toxicity, None),
    "op10_licence_scan": (op10_licence_scan, None),
    "op11_spelling_variants": (op11_spelling_variants, OP11_SQL),
    "op12_language_id": (op12_language_id, None),
    "op13_embedding_whitening": (op13_embedding_whitening, None),
}

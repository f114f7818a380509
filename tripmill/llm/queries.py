"""The operators with production parameters over their whole tables, as registered queries."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmill.llm import (
    bytebpe,
    codes,
    collisions,
    htmltext,
    langid,
    linededup,
    mixing,
    pii,
    pivotsearch,
    resampling,
    simhash,
    suffixdedup,
    tokenfile,
)
from tripmill.llm.common import TEXT_ROWS, VECTOR_ROWS, hand_over, stored, table
from tripmill.sources.workdir import new_workdir

Query = Callable[[SparkSession, str], DataFrame]

BYTE_BPE = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
END_ID = 1
NEAR_SHINGLE, NEAR_BITS = 3, 3
# A line on so many sites is boilerplate.
BOILERPLATE_SITES = 4
# Share of the greatest entropy that the mixture is to reach, and the most passes over a source.
MIX_ENTROPY, MIX_REPEATS = 0.95, 2.0
# Tokens of a block: some dozen documents.
MIX_BLOCK = 1 << 14
# Strings of so many bytes that repeat across documents go.
REPEAT_BYTES = 50


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = langid.identify(docs, langid.train(docs), keep_text=False)
    return found.select(
        "doc_id", langid.held_out().alias("held_out"), "lang_pred", "score", "rejected"
    )


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    cleaned = linededup.without_spread_lines(docs, BOILERPLATE_SITES)
    return cleaned.select(
        "doc_id",
        "n_lines",
        "n_removed",
        "n_chars",
        F.sha2("text", 256).alias("text_sha256"),
    )


def op3_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    hand_over(spark, TEXT_ROWS)
    return htmltext.main_text(table(spark, sf_dir, "pages").select("page_id", "url", "html"))


def op4_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    mixed = mixing.mix(docs, MIX_ENTROPY, MIX_REPEATS, block_tokens=MIX_BLOCK)
    placed = ["mix_weight", "mix_epoch", "mix_order", "mix_position"]
    return mixed.select("doc_id", "source", "n_chars", *placed)


def op5_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.personal_data(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id",
        *[pii.count_of(F.col("base"), kind).alias(f"n_{kind}") for kind in pii.KINDS],
        F.sha2(pii.written(F.col("base")), 256).alias("base_sha256"),
        pii.written(F.concat("base", "added")).alias("spans"),
    )


def op6_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_workdir(spark, "op6_token_files")
    tokenfile.write_token_files(table(spark, sf_dir, "documents"), path, WORD_BPE, END_ID)
    return tokenfile.with_crc32(tokenfile.read_token_files(spark, path))


def op7_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    hand_over(spark, VECTOR_ROWS)
    vectors = table(spark, sf_dir, "embeddings")
    return pivotsearch.top_products(vectors, F.col("vec_id") % 100 == 0, 10)


def op10_near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    hand_over(spark, VECTOR_ROWS)
    vectors = table(spark, sf_dir, "embeddings")
    return collisions.nearest_cosines(vectors, F.col("vec_id") % 50 == 0, 5)


def op8_simhash_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    hand_over(spark, TEXT_ROWS)
    docs = table(spark, sf_dir, "documents")
    found = simhash.near_duplicates(docs, NEAR_SHINGLE, NEAR_BITS)
    digits = F.lpad(F.lower(F.hex("fingerprint")), 16, "0")
    return found.select("doc_id", digits.alias("fingerprint"), "component_id")


def op9_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    hand_over(spark, TEXT_ROWS)
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    encoded = bytebpe.encode(docs, BYTE_BPE, public_tokenizers.PATTERN)
    decoded = bytebpe.decode(encoded, BYTE_BPE, public_tokenizers.PATTERN)
    return decoded.select(
        "doc_id",
        "n_tokens",
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op11_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    hand_over(spark, TEXT_ROWS)
    docs, target = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    return resampling.resample(docs, target, percent=25, buckets=10_000, most=2, seed=7)


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    hand_over(spark, VECTOR_ROWS)
    vectors = table(spark, sf_dir, "embeddings")
    found = codes.compress(vectors, parts=8, entries=16, rounds=6, scale=4096, label="label")
    return codes.group_errors(stored(found, "op12-codes")).select(
        "vec_id",
        F.lower(F.hex("code")).alias("code"),
        "error",
        "label_error",
        F.sha2("codebooks", 256).alias("codebooks_sha256"),
    )


def op13_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    hand_over(spark, TEXT_ROWS)
    found = suffixdedup.without_repeats(table(spark, sf_dir, "documents"), REPEAT_BYTES)
    removed = F.aggregate(
        "spans", F.lit(0).cast("long"), lambda n, span: n + span["end"] - span["start"]
    )
    return found.select(
        "doc_id",
        "n_bytes",
        removed.alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


QUERIES: dict[str, Query] = {
    "op1_language_id": op1_language_id,
    "op2_line_dedup": op2_line_dedup,
    "op3_html_text": op3_html_text,
    "op4_source_mixing": op4_source_mixing,
    "op5_personal_data": op5_personal_data,
    "op6_token_files": op6_token_files,
    "op7_exact_top_k": op7_exact_top_k,
    "op8_simhash_near_duplicates": op8_simhash_near_duplicates,
    "op9_byte_bpe": op9_byte_bpe,
    "op10_near_vectors": op10_near_vectors,
    "op11_importance_resampling": op11_importance_resampling,
    "op12_vector_codes": op12_vector_codes,
    "op13_suffix_dedup": op13_suffix_dedup,
}

LINES_SQL = f"""
with raw as (
    select doc_id, source, unnest(string_split(text, chr(10))) as line,
        generate_subscripts(string_split(text, chr(10)), 1) as pos
    from documents
), lines as (
    select doc_id, source, pos, line,
        trim(line, ' ' || chr(9) || chr(11) || chr(12) || chr(13)) as stripped
    from raw
), spread as (
    select stripped from lines where stripped <> ''
    group by stripped
    having count(distinct coalesce('=' || source, '')) >= {BOILERPLATE_SITES}
), marked as (
    select l.*, s.stripped is not null and row_number() over (
        partition by l.stripped order by l.doc_id nulls last, l.pos) > 1 as gone
    from lines l left join spread s on l.stripped = s.stripped
), cleaned as (
    select doc_id, count(*) as n_lines, count(*) filter (where gone) as n_removed,
        coalesce(string_agg(line, chr(10) order by pos) filter (where not gone), '') as text
    from marked group by doc_id
)
select d.doc_id,
    cast(coalesce(c.n_lines, 0) as integer) as n_lines,
    cast(coalesce(c.n_removed, 0) as integer) as n_removed,
    length(c.text) as n_chars,
    sha256(c.text) as text_sha256
from documents d left join cleaned c on d.doc_id = c.doc_id
"""

PRODUCTS_SQL = """
with whole as (
    select vec_id, list_transform(embedding, lambda x: floor(1024 * cast(x as double))) as vector
    from embeddings
    where vec_id is not null and embedding is not null
        and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
), scored as (
    select q.vec_id as query_id, c.vec_id,
        list_dot_product(q.vector, c.vector) as score
    from whole q join whole c on q.vec_id % 100 = 0 and q.vec_id <> c.vec_id
)
select query_id, cast(rank as integer) as rank, vec_id, cast(score as bigint) as score
from (select *, row_number() over (partition by query_id order by score desc, vec_id) as rank
    from scored)
where rank <= 10
"""

# CRC-32 of a text, in the reflected form with its polynomial 0xEDB88320, a nibble at a time.
RESAMPLING_SQL = """
with recursive steps(i, step, n) as (
    select range, range, 0 from range(16)
    union all
    select i, xor(step >> 1, case when step % 2 = 1 then 3988292384 else 0 end), n + 1
    from steps where n < 4
), nibbles as (
    select list(cast(step as bigint) order by i) as t from steps where n = 4
), worded as (
    select 'd' as side, doc_id as id, row_number() over () as place, regexp_extract_all(
        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') as words
    from documents
    union all
    select 'b', null, null, regexp_extract_all(
        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')
    from benchmark
), featured as (
    select side, place, unnest(list_concat(words, list_transform(
        range(1, len(words)), lambda i: words[i] || ' ' || words[i + 1]))) as feature
    from worded where len(words) > 0
), hashed as (
    select feature, xor(list_reduce(
        list_prepend(4294967295, flatten(list_transform(range(0, octet_length(encode(feature))),
            lambda i: [cast(('0x' || substr(hex(encode(feature)), 2 * i + 2, 1)) as bigint),
                       cast(('0x' || substr(hex(encode(feature)), 2 * i + 1, 1)) as bigint)]))),
        lambda c, nibble: xor(c >> 4, t[(xor(c, nibble) & 15) + 1])), 4294967295) % 10000 as bucket
    from (select distinct feature from featured), nibbles
), counted as (
    select bucket, count(*) filter (where side = 'd') as s, count(*) filter (where side = 'b') as t
    from featured join hashed using (feature) group by bucket
), totals as (
    select coalesce(sum(s), 0) as all_s, coalesce(sum(t), 0) as all_t from counted
), gained as (
    select bucket, cast(floor(1000 * ln(cast(t + 1 as double) * (all_s + 10000)
        / (cast(s + 1 as double) * (all_t + 10000)))) as bigint) as gain
    from counted, totals
), summed as (
    select place, count(*) as n_features, cast(sum(gain) as bigint) as gains
    from featured join hashed using (feature) join gained using (bucket)
    where side = 'd' group by place
), weighed as (
    select id as doc_id, coalesce(len(words), 0) as n_words,
        coalesce(n_features, 0) as n_features,
        coalesce((gains - ((gains % n_features) + n_features) % n_features) // n_features, 0)
            as weight,
        cast(('0x' || substr(sha256('7:' || id), 1, 8)) as bigint) as h
    from worded left join summed using (place) where side = 'd'
), scored as (
    select *, weight + cast(floor(-1000 * ln(-ln((h + 0.5::double) / 4294967296))) as bigint) as score
    from weighed
), ranked as (
    select *, row_number() over (partition by n_words >= 20 order by score desc, doc_id) as place
    from scored
)
select doc_id, n_features, weight, score,
    case when n_words >= 20
        and place <= (select 25 * count(*) // 100 from scored where n_words >= 20)
        then place end as rank
from ranked
"""

_NEAREST_SQL = """
assigned{n} as materialized (
    select id, p, min(struct_pack(d := d, e := e)) as best
    from (
        select c.id, c.p, b.e, cast(coalesce(list_sum(list_transform(
            range(1, len(c.x) + 1), lambda i: (c.x[i] - b.x[i]) * (c.x[i] - b.x[i]))), 0)
            as bigint) as d
        from cut c join book{n} b on c.p = b.p)
    group by id, p
)"""
_MEANS_SQL = """
book{m} as materialized (
    select p, e, list(v order by i) as x
    from (
        select b.p, b.e, u.i, coalesce(any_value(m.mean), any_value(b.x[u.i])) as v
        from book{n} b, range(1, 9) u(i) left join (
            select a.p, a.best.e as e, i.i,
                cast(floor(cast(sum(c.x[i.i]) as double) / count(*)) as bigint) as mean
            from assigned{n} a join cut c on a.id = c.id and a.p = c.p, range(1, 9) i(i)
            group by all
        ) m on m.p = b.p and m.e = b.e and m.i = u.i
        group by b.p, b.e, u.i)
    group by p, e
)"""
CODES_SQL = (
    """
with kept as (
    select vec_id, label, row_number() over (order by vec_id) as id,
        list_transform(embedding, lambda x: cast(floor(4096 * cast(x as double)) as bigint)) as v
    from embeddings
    where embedding is not null
        and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
), cut as materialized (
    select id, p, v[8 * p + 1 : 8 * p + 8] as x from kept, range(8) parts(p)
), book0 as (select p, id - 1 as e, x from cut where id <= 16),"""
    + ",".join(_NEAREST_SQL.format(n=n) + "," + _MEANS_SQL.format(n=n, m=n + 1) for n in range(6))
    + ","
    + _NEAREST_SQL.format(n=6)
    + """, coded as (
    select id, string_agg(printf('%02x', best.e), '' order by p) as code,
        cast(sum(best.d) as bigint) as error
    from assigned6 group by id
), books as (
    select sha256(string_agg(array_to_string(x, ','), ',' order by p, e)) as codebooks_sha256
    from book6
)
select vec_id, code, error, cast(sum(error) over (partition by label) as bigint) as label_error,
    codebooks_sha256
from kept join coded using (id), books
"""
)

# Bytes as pairs of hexadecimal digits.
REPEATS_SQL = f"""
with texts as (
    select row_number() over () as place, doc_id, coalesce(hex(encode(text)), '') as digits
    from documents
), starts as (
    select place, doc_id, pos, md5_number(substr(digits, 2 * pos + 1, {2 * REPEAT_BYTES})) as own
    from (
        select *, unnest(range(0, len(digits) // 2 - {REPEAT_BYTES - 1})) as pos
        from texts where len(digits) >= {2 * REPEAT_BYTES})
), gone as (
    select place, pos from starts join (
        select own, min(doc_id) as least from starts group by own having min(doc_id) < max(doc_id))
        using (own)
    where doc_id > least
), runs as (
    select place, min(pos) as a, max(pos) + {REPEAT_BYTES} as b from (
        select place, pos, sum(fresh) over (partition by place order by pos) as run from (
            select place, pos, case when pos - lag(pos, 1, -{REPEAT_BYTES + 1}) over (
                partition by place order by pos) > {REPEAT_BYTES} then 1 else 0 end as fresh
            from gone))
    group by place, run
), pieces as (
    select place, a, b, lag(b, 1, 0) over (partition by place order by a) as before,
        lead(a) over (partition by place order by a) is null as last
    from runs
), kept as (
    select place, sum(b - a) as n_removed, count(*) as n_spans,
        string_agg(substr(digits, 2 * before + 1, 2 * (a - before)) ||
            case when last then substr(digits, 2 * b + 1) else '' end, '' order by a) as digits
    from pieces join texts using (place) group by place
)
select doc_id, cast(len(t.digits) // 2 as bigint) as n_bytes,
    cast(coalesce(n_removed, 0) as bigint) as n_removed,
    cast(coalesce(n_spans, 0) as bigint) as n_spans,
    sha256(unhex(coalesce(k.digits, t.digits))) as kept_sha256
from texts t left join kept k using (place)
"""

ORACLE_SQL: dict[str, str] = {
    "op2_line_dedup": LINES_SQL,
    "op7_exact_top_k": PRODUCTS_SQL,
    "op11_importance_resampling": RESAMPLING_SQL,
    "op12_vector_codes": CODES_SQL,
    "op13_suffix_dedup": REPEATS_SQL,
}

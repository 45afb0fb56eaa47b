"""One registered query for each operator, with its check SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from croploom.llm import ann, centroids, coder, decontam, dedup, langid, merkle, pieces, secrets, surrogates, tokencount, toolcalls, toxicity
from croploom.session import shared_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def add(fn):
        QUERIES[fn.__name__] = fn
        if sql:
            ORACLES[fn.__name__] = sql
        return fn

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


WORD_BPE = public_tokenizers.path("word_bpe_49k.json")


@query()
def op5_token_id_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_path(spark, "token-ids")
    coder.write_ids(table(spark, sf_dir, "documents"), WORD_BPE, path)
    return coder.read_digests(spark.read.parquet(path))


_LOW = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


#: Tools of the calls derived from conversations.
SCHEMAS = {
    "ask": {"chars": ("integer", True), "meta": ("object", False), "text": ("string", True)},
    "configure": {"text": ("string", True)},
}


def calls_of(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Calls and results from plain conversations.

    Every turn that is not the assistant's, one without role included, is a call that uses the one two turns
    before, and the assistant's turns are results of the turn before, a third of them given once more, with some
    results of calls that there are not.  Depending on its length the text's argument
    list lacks an argument, has one of a wrong type, is cut off or has one too many.
    """
    t = turns.withColumn("n", F.length("text").cast("long"))
    name = F.concat(F.lit("t"), F.col("turn").cast("string"))
    back = lambda k: F.concat(F.lit("t"), (F.col("turn") - k).cast("string"))
    text = F.concat(F.lit('"text" : '), toolcalls.quoted(F.col("text")))
    chars = F.concat(F.lit(', "chars": '), F.when(F.expr("n % 11 = 0"), F.concat(F.lit('"'), F.col("n").cast("string"), F.lit('"'))).otherwise(F.col("n").cast("string")))
    meta = F.concat(F.lit(', "meta": {"z": [1, 2.5, null], "a": '), F.when(F.expr("n % 2 = 0"), F.lit("true")).otherwise(F.lit("false")), F.lit("}"))
    whole = F.concat(F.lit("{ "), text, F.when(F.expr("n % 7 = 0"), F.lit("")).otherwise(chars), F.when(F.expr("n % 5 = 0"), meta).otherwise(F.lit("")), F.when(F.expr("n % 13 = 0"), F.lit("")).otherwise(F.lit(" }")))
    tool = F.when(F.col("role") == "user", "ask").when(F.col("role") == "system", "configure").otherwise(F.col("role"))
    calls = t.filter("not role <=> 'assistant'").select("conv_id", name.alias("call_id"), F.when(F.col("turn") >= 2, back(2)).alias("parent_id"), tool.alias("tool"), whole.alias("arguments"), "turn")
    said = t.filter("role = 'assistant'")
    results = said.select("conv_id", back(1).alias("call_id"), F.col("text").alias("content"), "turn")
    again = said.filter("n % 3 = 0").select("conv_id", back(1).alias("call_id"), F.concat(F.col("text"), F.lit(" (again)")).alias("content"), (F.col("turn") + 100).alias("turn"))
    astray = said.filter("n % 17 = 0").select("conv_id", F.when(F.expr("n % 2 = 0"), "nobody").alias("call_id"), F.col("text").alias("content"), "turn")
    return calls, results.unionByName(again).unionByName(astray)


@query(
    """
    with recursive t as (
        select *, length(text) n, to_json(text)::varchar q from conversations
    ), c as (
        select distinct conv_id, turn, 't' || turn call_id, case when turn >= 2 then 't' || (turn - 2) end parent_id,
            case role when 'user' then 'ask' when 'system' then 'configure' else role end tool, n, q,
            case when n % 11 = 0 then '"' || n || '"' else n::varchar end ch from t where role is distinct from 'assistant'
    ), res as (
        select distinct conv_id, 't' || (turn - 1) call_id, text content, turn from t where role = 'assistant'
        union select conv_id, 't' || (turn - 1), text || ' (again)', turn + 100 from t where role = 'assistant' and n % 3 = 0
        union select conv_id, case when n % 2 = 0 then 'nobody' end, text, turn from t where role = 'assistant' and n % 17 = 0
    ), rr as (
        select res.*, c.call_id is not null has_call, row_number() over (partition by res.conv_id, res.call_id order by res.turn, content) k,
            count(*) over (partition by res.conv_id, res.call_id) nr from res left join c on c.conv_id = res.conv_id and c.call_id = res.call_id
    ), j as (
        select c.*, p.call_id is not null has_parent, r.content, coalesce(nr, 0) n_results from c
        left join c p on p.conv_id = c.conv_id and p.call_id = c.parent_id
        left join rr r on r.conv_id = c.conv_id and r.call_id = c.call_id and r.k = 1
    ), d as (
        select conv_id, call_id, 0::bigint as depth from j where not has_parent
        union all
        select j.conv_id, j.call_id, d.depth + 1 from j join d on d.conv_id = j.conv_id and d.call_id = j.parent_id
    ), a as (
        select j.*, depth, n % 13 = 0 cut, '{' || case when n % 7 = 0 then '' else '"chars":' || ch || ',' end
            || case when n % 5 = 0 then '"meta":{"a":' || (n % 2 = 0)::varchar || ',"z":[1,2.5,null]},' else '' end || '"text":' || q || '}' canon,
            '{ "text" : ' || q || case when n % 7 = 0 then '' else ', "chars": ' || ch end
            || case when n % 5 = 0 then ', "meta": {"z": [1, 2.5, null], "a": ' || (n % 2 = 0)::varchar || '}' else '' end raw
        from j join d on d.conv_id = j.conv_id and d.call_id = j.call_id
    ), b as (
        select conv_id, call_id, tool, depth, turn, parent_id, content, n_results, 0 kind, case when cut then to_json(raw)::varchar else canon end args, list_sort(list_filter([
            case when parent_id is not null and not has_parent then 'no_parent' end,
            case when n_results = 0 then 'no_result' end,
            case when tool is null or tool not in ('ask', 'configure') then 'unknown_tool' when cut then 'not_an_object' end,
            case when tool = 'ask' and not cut and n % 7 = 0 then 'missing:chars' end,
            case when tool = 'ask' and not cut and n % 7 <> 0 and n % 11 = 0 then 'type:chars' end,
            case when tool = 'configure' and not cut and n % 7 <> 0 then 'unknown:chars' end,
            case when tool = 'configure' and not cut and n % 5 = 0 then 'unknown:meta' end], lambda x: x is not null)) problems from a
        union all
        select conv_id, call_id, null, null, turn, null, content, 1, 1, 'null',
            case when call_id is null then ['no_call', 'no_id'] when not has_call then ['no_call'] else ['repeated_result'] end
        from rr where k > 1 or not has_call
    ), o as (
        select *, row_number() over (partition by conv_id order by kind, depth, turn, call_id nulls first, content) pos from b
    )
    select conv_id, call_id, tool, depth, pos::bigint as position, n_results::bigint n_results, array_to_string(problems, ',') problems,
        sha256('{"arguments":' || args || ',"id":' || coalesce('"' || call_id || '"', 'null') || ',"parent":' || coalesce('"' || parent_id || '"', 'null') || ',"position":' || pos
            || ',"result":' || coalesce(to_json(content)::varchar, 'null') || ',"tool":' || coalesce('"' || tool || '"', 'null') || '}') line_sha256 from o
    """
)
def op3_tool_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    linked = toolcalls.link(*calls_of(table(spark, sf_dir, "conversations")), SCHEMAS)
    return linked.select("conv_id", "call_id", "tool", "depth", "position", "n_results", F.array_join("problems", ",").alias("problems"), F.sha2("line", 256).alias("line_sha256"))


@query()
def op4_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest_neighbours(table(spark, sf_dir, "embeddings"))


@query(
    rf"""
    with recursive w as (
        select doc_id, regexp_extract_all({_LOW}, '[^\x20\x09-\x0D]+') ws from documents
    ), s as (
        select distinct doc_id, unnest(case when len(ws) = 0 then [] when len(ws) < 5 then [ws]
            else list_transform(range(1, len(ws) - 3), lambda i: ws[i:i + 4]) end) g from w
    ), n as (
        select doc_id, count(*) c from s group by 1
    ), e as (
        select a.doc_id x, b.doc_id y from s a join s b on a.g = b.g and a.doc_id <> b.doc_id
        join n na on na.doc_id = a.doc_id join n nb on nb.doc_id = b.doc_id
        group by 1, 2, na.c, nb.c having 100 * count(*) >= 85 * (na.c + nb.c - count(*))
    ), r as (
        select doc_id x, doc_id y from documents
        union
        select r.x, e.y from r join e on r.y = e.x
    )
    select d.doc_id, coalesce(any_value(n.c), 0)::bigint n_shingles, min(r.y) component_id, d.doc_id = min(r.y) kept
    from documents d join r on r.x = d.doc_id left join n on n.doc_id = d.doc_id group by d.doc_id
    """
)
def op6_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.near_duplicates(table(spark, sf_dir, "documents"))


PIECES = public_tokenizers.path("piece_bpe_32k.model")


@query()
def op1_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = pieces.encode(table(spark, sf_dir, "documents").select("doc_id", "text"), PIECES, check="lossless")
    digest = F.expr("sha2(array_join(ids, ','), 256)")
    return coded.select("doc_id", F.size("ids").cast("long").alias("n_ids"), digest.alias("ids_sha256"), "lossless")


@query()
def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    found = langid.identify(docs.select("doc_id", "text"), *langid.learn(docs))
    held_out = F.coalesce(F.expr("crc32(cast(doc_id as string)) % 3 = 1"), F.lit(False))
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


@query()
def op7_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.scan_corpus(table(spark, sf_dir, "documents").select("doc_id", "text"))
    count = {f"n_{k}": F.expr(f"cast(size(filter(secrets, s -> s.kind = '{k}')) as bigint)") for k in secrets.KINDS}
    joined = "array_join(transform({}, s -> concat_ws(':', s.kind, s.start, s.stop)), ',')"
    base = joined.format("filter(secrets, s -> s.kind <> 'markov')")
    return found.select(
        "doc_id",
        *(c.alias(k) for k, c in count.items()),
        F.expr(f"sha2({base}, 256)").alias("base_sha256"),
        F.expr(joined.format("secrets")).alias("spans"),
    )


_WORDS = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


@query(
    rf"""
    with b as (
        select item_id, regexp_extract_all({_LOW}, '{_WORDS}') ws from benchmark
    ), bw as (
        select distinct item_id, unnest(case when len(ws) = 0 then [] when len(ws) < 10 then [ws]
            else list_transform(range(1, len(ws) - 8), lambda i: ws[i:i + 9]) end) g from b
    ), d as (
        select doc_id, regexp_extract_all({_LOW}, '{_WORDS}') ws from documents
    ), ks as (
        select distinct len(g) k from bw
    ), dw as (
        select doc_id, k, unnest(range(1, len(ws) - k + 2)) i, ws from d, ks
    ), h as (
        select doc_id, i, k, item_id from dw join bw on len(bw.g) = dw.k and bw.g = ws[i:i + k - 1]
    ), p as (
        select doc_id, count(distinct j) n_hit from (select doc_id, unnest(range(i, i + k)) j from h) group by 1
    ), t as (
        select doc_id, count(*) n_items, string_agg(x, ',' order by x) ids from (select distinct doc_id, item_id::varchar x from h) group by 1
    )
    select d.doc_id, len(ws)::bigint n_words, coalesce(n_hit, 0)::bigint n_hit, coalesce(n_items, 0)::bigint n_items,
        sha256(coalesce(ids, '')) items_sha256, coalesce(n_hit, 0) > 0 contaminated
    from d left join p on p.doc_id = d.doc_id left join t on t.doc_id = d.doc_id
    """
)
def op10_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontam.decontaminate(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"))
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda acc, s: acc + s["words"])
    return found.select(
        "doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.size("spans") > 0).alias("contaminated"),
    )


RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


@query()
def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_path(spark, "flat-tokens")
    tokencount.write_flat(table(spark, sf_dir, "documents").select("doc_id", "text"), RANKS, path)
    return tokencount.count_documents(spark.read.parquet(path))


@query()
def op9_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return surrogates.pseudonymise(docs, b"a key that a job would read from its secret store")


#: Unsigned crc32 of a decimal number, bit by bit.
_CRC = (
    "xor(list_reduce(list_concat([4294967295], list_transform(string_split(doc_id::varchar, ''), lambda c: ascii(c)::bigint)), "
    "lambda a, c: list_reduce([xor(a, c), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, y: xor(x >> 1, 3988292384 * (x & 1)))), 4294967295)"
)
_LEAF = " || ".join(
    f"case when {c} is null then '-' else strlen({c}::varchar) || ':' || {c}::varchar end" for c in ("doc_id", "source", "lang", "n_chars")
)
_TEXT = " || case when {0} is null then '-' else strlen({0}) || ':' || {0} end"
_LOWERED = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


@query(
    f"""
    with recursive d as (
        select doc_id, coalesce('=' || source, '') g, sha256({_LEAF}{_TEXT.format("text")}) leaf,
            sha256({_LEAF}{_TEXT.format(_LOWERED)}) low, {_CRC} % 5 = 0 hit from documents
    ), l as (
        select *, row_number() over (partition by g order by doc_id nulls first, leaf) - 1 i, count(*) over (partition by g) n from d
    ), t as (
        select g, 0 lv, i, leaf h, n from l
        union all
        select g, lv + 1, i // 16, sha256(string_agg(h, '' order by i)), (n + 15) // 16 from t where n > 1 group by g, lv, i // 16, n
    ), s as (
        select g, h subroot, row_number() over (order by g) - 1 i, count(*) over () n from t where n = 1
    ), u as (
        select '*' g, 0 lv, i, subroot h, n from s
        union all
        select g, lv + 1, i // 16, sha256(string_agg(h, '' order by i)), (n + 15) // 16 from u where n > 1 group by g, lv, i // 16, n
    ), a as (
        select * from t union all select * from u
    ), r as (
        select g, lv, i // 16 run, list(h order by i) kids, n from a where n > 1 group by g, lv, i // 16, n
    ), c as (
        select g g0, i i0, doc_id, g, 0 lv, i, n, case when hit then low else leaf end h, '' p from l
        union all
        select c.g0, c.i0, c.doc_id, case when c.n > 1 then c.g else '*' end, case when c.n > 1 then c.lv + 1 else 0 end,
            case when c.n > 1 then c.i // 16 else s.i end, case when c.n > 1 then (c.n + 15) // 16 else s.n end,
            case when c.n > 1 then sha256(array_to_string(r.kids[:c.i % 16], '') || c.h || array_to_string(r.kids[c.i % 16 + 2:], '')) else c.h end,
            case when c.n > 1 then c.p || array_to_string(r.kids[:c.i % 16], '') || array_to_string(r.kids[c.i % 16 + 2:], '') else c.p end
        from c left join r on r.g = c.g and r.lv = c.lv and r.run = c.i // 16 left join s on s.g = c.g
        where c.n > 1 or c.g <> '*'
    )
    select l.doc_id, l.leaf, s.subroot, u.h root, sha256(c.p) proof_sha256, c.h folded_root, c.h = u.h verified
    from l join s on s.g = l.g join c on c.g0 = l.g and c.i0 = l.i and c.g = '*' and c.n = 1 join u on u.n = 1
    """
)
def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.manifest(table(spark, sf_dir, "documents"))


def _rounds(n: int) -> str:
    """SQL of n rounds on long tables: x (row, place, value) of vectors, c0 (cluster, place, value) of centroids."""
    out = []
    for k in range(n + 1):
        out.append(
            f"""a{k} as materialized (
            select r, c, dist from (
                select r, c, dist, row_number() over (partition by r order by dist, c) o from (
                    select x.r, c.c, sum((x.x - c.x) * (x.x - c.x))::bigint dist from x join c{k} c on c.i = x.i group by 1, 2)
            ) where o = 1
        ), c{k + 1} as materialized (
            select c{k}.c, c{k}.i, coalesce(m.x, c{k}.x) x from c{k} left join (
                select c, i, ((s - ((s % n) + n) % n) // n)::bigint x from (select c, i, sum(x) s, count(*) n from a{k} join x using (r) group by 1, 2)
            ) m on m.c = c{k}.c and m.i = c{k}.i
        )"""
        )
    return ", ".join(out)


@query(
    f"""
    with v as materialized (
        select vec_id, row_number() over () r, list_transform(embedding, lambda e: floor(256 * e::double)::bigint) v
        from embeddings where len(embedding) = 64 and len(list_filter(embedding, lambda e: e is not null and isfinite(e))) = 64
    ), x as materialized (
        select r, unnest(range(1, 65)) i, unnest(v) x from v
    ), f as (
        select v, row_number() over (order by sha256('2:' || vec_id), v) - 1 c from v where vec_id is not null
        order by sha256('2:' || vec_id), v limit 40
    ), c0 as materialized (
        select c, unnest(range(1, 65)) i, unnest(v) x from f
    ), {_rounds(5)}, h as (
        select c, sha256(string_agg(x::varchar, ',' order by i)) centroid_sha256 from c5 group by c
    )
    select v.vec_id, c::int as cluster, dist as distance, (sum(dist) over (partition by c))::bigint cluster_inertia,
        (sum(dist) over ())::bigint inertia, centroid_sha256 from a5 join v using (r) join h using (c)
    """
)
def op12_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.cluster(table(spark, sf_dir, "embeddings"))


@query()
def op13_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.learn(docs, table(spark, sf_dir, "labels"))
    held_out = F.coalesce(F.expr("crc32(cast(doc_id as string)) % 4 = 2"), F.lit(False))
    scored = toxicity.score(docs, model, spans=False)
    return scored.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))

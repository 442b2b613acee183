"""The query of each operator over its whole table, with SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallymark.llm import (
    cover_tree,
    decontaminate,
    language,
    lloyd,
    manifest,
    minhash,
    mixing,
    packing,
    quality,
    secrets,
    token_output,
    toxicity,
    warc_zip,
)
from tallymark.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(function: Query) -> Query:
        QUERIES[name] = function
        if sql is not None:
            ORACLES[name] = sql
        return function

    return register


DECONTAMINATION_SQL = r"""
with d as (select doc_id, list_filter(string_split(translate(coalesce(text, ''), {upper}, {lower}), ' '), lambda w: w <> '') as ws from documents),
b as (select item_id, list_filter(string_split(translate(coalesce(text, ''), {upper}, {lower}), ' '), lambda w: w <> '') as ws from benchmark),
g as (
  select item_id, array_to_string(ws[k:k + least(len(ws), 10) - 1], ' ') as gram, least(len(ws), 10) as n
  from (select item_id, ws, unnest(range(1, greatest(len(ws) - 9, 1) + 1)) as k from b where len(ws) > 0)),
sizes as (select distinct n from g),
p as (
  select doc_id, k, n, array_to_string(ws[k:k + n - 1], ' ') as gram
  from (select doc_id, ws, n, unnest(range(1, len(ws) - n + 2)) as k from d, sizes where len(ws) >= n)),
m as (select doc_id, k, p.n as n, item_id from p join g on p.gram = g.gram and p.n = g.n),
h as (select doc_id, count(distinct spot) as n_hit from (select doc_id, unnest(range(k, k + n)) as spot from m) group by doc_id),
i as (
  select doc_id, count(*) as n_items, array_to_string(list_sort(list(id)), ',') as ids
  from (select distinct doc_id, cast(item_id as varchar) as id from m) group by doc_id)
select d.doc_id, cast(len(ws) as bigint) as n_words, cast(coalesce(n_hit, 0) as bigint) as n_hit,
       cast(coalesce(n_items, 0) as bigint) as n_items, sha256(coalesce(ids, '')) as items_sha256,
       coalesce(n_hit, 0) > 0 as contaminated
from d left join h using (doc_id) left join i using (doc_id)
"""


def _words_sql() -> tuple[str, str]:
    spaces = [*range(0x01, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]
    lower = "abcdefghijklmnopqrstuvwxyz"
    chars = " || ".join(f"chr({c})" for c in spaces)
    return f"'{lower.upper()}' || {chars}", f"'{lower}{' ' * len(spaces)}'"


@query("op2_decontamination", DECONTAMINATION_SQL.format(upper=_words_sql()[0], lower=_words_sql()[1]))
def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    items = F.sha2(F.concat_ws(",", "item_ids"), 256)
    return found.select("doc_id", "n_words", "n_hit", "n_items", items.alias("items_sha256"), "contaminated")


SECRETS_SQL = r"""
with d as (select doc_id, coalesce(text, '') as t from documents),
{parts},
s as (
  select doc_id, kind, nth, upto - m as b, upto as e
  from (
    select doc_id, kind, nth, held, least_n, m,
           sum(before + m) over (partition by doc_id, kind order by k rows unbounded preceding) as upto
    from parts)
  where held >= least_n),
f as (
  select doc_id, count(*) filter (kind = 'assign') as n_assign, count(*) filter (kind = 'access') as n_access,
         count(*) filter (kind = 'hex') as n_hex,
         string_agg(kind || ':' || cast(b as bigint) || ':' || cast(e as bigint), ',' order by b, nth) as spans
  from s group by doc_id)
select d.doc_id, cast(coalesce(n_assign, 0) as bigint) as n_assign, cast(coalesce(n_access, 0) as bigint) as n_access,
       cast(coalesce(n_hex, 0) as bigint) as n_hex, sha256(coalesce(spans, '')) as base_sha256, coalesce(spans, '') as spans
from d left join f using (doc_id)
"""


def _parts_sql() -> str:
    kinds = (
        ("assign", 0, r"""(?i:(password|passwd|secret|token|api_?key))["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)""", 2, 12),
        ("access", 1, r"AKIA[A-Z0-9]+", 0, 18),
        ("hex", 2, r"[0-9a-f]+", 0, 16),
    )
    each = [
        f"select doc_id, '{kind}' as kind, {nth} as nth, {least} as least_n, k, length(m[k]) as m, length(g[k]) as held, "
        f"length(p[k]) as before from (select doc_id, m, g, p, unnest(range(1, len(m) + 1)) as k from ("
        f"select doc_id, regexp_extract_all(t, '{pattern}') as m, regexp_extract_all(t, '{pattern}', {group}) as g, "
        f"string_split_regex(t, '{pattern}') as p from d))"
        for kind, nth, pattern, group, least in kinds
    ]
    return "parts as (" + " union all ".join(each) + ")"


@query("op9_secret_scan", SECRETS_SQL.replace("{parts}", _parts_sql()))
def op9_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.scan(table(spark, sf_dir, "documents").select("doc_id", "text"))
    spans = F.concat_ws(",", F.transform("secret_spans", lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])))

    def count(kind: str):
        return F.size(F.filter("secret_spans", lambda s: s["kind"] == kind)).cast("long")

    counts = [count(rule.kind).alias(f"n_{rule.kind}") for rule in secrets.RULES]
    return found.select("doc_id", *counts, F.sha2(spans, 256).alias("base_sha256"), spans.alias("spans"))


@query("op4_token_output")
def op4_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = token_output.write_tokens(table(spark, sf_dir, "documents"))
    return token_output.digest(token_output.read_tokens(spark, folder)).select("doc_id", "start", "n_tokens", "ids_crc32")


@query("op10_packing")
def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


@query("op1_minhash")
def op1_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.classes(table(spark, sf_dir, "documents"))


WARC_SQL = r"""
with p as (select page_id, coalesce(html, '') as t from pages),
h as (select page_id, t, sha1(t) as hex from p),
g as (select page_id, t, hex, list_transform(range(8), lambda i: cast('0x' || substr(hex, cast(i * 5 + 1 as int), 5) as bigint)) as v from h),
s as (
  select page_id, strlen(t) as payload_bytes, min(page_id) over (partition by hex) as first,
         array_to_string(list_transform(range(32), lambda j: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', cast(((v[cast(j // 4 as int) + 1] >> cast(15 - 5 * (j % 4) as int)) & 31) + 1 as int), 1)), '') as payload_digest
  from g)
select page_id, cast(payload_bytes as bigint) as payload_bytes, payload_digest,
       case when page_id = first then 'response' else 'revisit' end as record_type,
       case when page_id = first then null else first end as refers_to
from s
"""


@query("op5_warc_zip", WARC_SQL)
def op5_warc_zip(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = warc_zip.write_archives(table(spark, sf_dir, "pages"))
    return warc_zip.read_archives(spark, folder)


VECTORS_SQL = r"""
with recursive v as (
  select vec_id, label, cast(embedding as double[]) as e from embeddings
  where label is not null and vec_id is not null and embedding is not null
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
    and len(list_filter(embedding, lambda x: x <> 0)) > 0),
links as (
  select a.vec_id as a, b.vec_id as b from v a join v b on a.label = b.label and a.vec_id <> b.vec_id and len(a.e) = len(b.e)
  where list_cosine_similarity(a.e, b.e) >= 0.93),
reach(a, b) as (
  select vec_id, vec_id from v union select r.a, l.b from reach r join links l on r.b = l.a),
least as (select a, min(b) as c from reach group by a),
n as (select a, count(*) as n from links group by a)
select vec_id, cast(coalesce(n, 0) as bigint) as n_links, coalesce(c, vec_id) as component_id, coalesce(c, vec_id) = vec_id as kept
from embeddings left join n on n.a = vec_id left join least on least.a = vec_id
"""


@query("op7_cover_tree", VECTORS_SQL)
def op7_cover_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cover_tree.similar_vectors(table(spark, sf_dir, "embeddings"))


@query("op3_toxicity")
def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.predictions(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op6_language")
def op6_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identified(table(spark, sf_dir, "documents"))


@query("op8_quality")
def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.predictions(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


MIXING_SQL = r"""
with d as (
  select doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) as size, md5(coalesce(text, '')) as content,
         cast('0x' || substr(sha256('1:' || coalesce(cast(doc_id as varchar), '') || ':' || md5(coalesce(text, ''))), 1, 15) as bigint) as key
  from documents),
z as (select source, cast(sum(size) as double) as z, row_number() over (order by source nulls last) % 3 as r from d group by source),
w as (select source, z, case r when 1 then 5.0::double when 2 then 2.0::double else 1.0::double end as w from z),
o as (
  select *, 2 * z / w as ratio,
         coalesce(sum(2 * z) over (order by 2 * z / w, source nulls last rows between unbounded preceding and 1 preceding), 0) as full_before,
         sum(w) over (order by 2 * z / w, source nulls last rows between current row and unbounded following) as open
  from w),
level as (
  select min_by((1.5 * (select sum(z) from z) - full_before) / open, ratio) as rate
  from o where (1.5 * (select sum(z) from z) - full_before) / open <= ratio),
t as (select source, cast(z as bigint) as z, least(rate * w, 2 * z) as target from w, level),
p as (
  select doc_id, size, z, target, cast(floor(target) as bigint) as budget,
         coalesce(sum(size) over (partition by d.source order by key, content rows between unbounded preceding and 1 preceding), 0) as before
  from d join t on d.source is not distinct from t.source)
select doc_id, cast(size as bigint) as size, z as source_size, target,
       cast(case when z = 0 then 0 else (budget // z) * size + least(greatest(budget % z - before, 0), size) end as bigint) as taken
from p
"""


@query("op12_mixing", MIXING_SQL)
def op12_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.taken(table(spark, sf_dir, "documents"))


def _manifest_sql(levels: int = 12, top: int = 8) -> str:
    """Trees level by level: up to 3**12 documents a source and 3**8 sources; a tree of one node stays as it is."""

    def coded(field: str, value: str) -> str:
        return f"coalesce(cast(strlen({value}) as varchar) || ':' || {value}, '-')"

    def leaf(text: str) -> str:
        fields = [(f, f"cast({f} as varchar)") for f in ("doc_id", "source", "lang", "n_chars")] + [("text", text)]
        return "sha256(" + " || ".join(coded(f, v) for f, v in fields) + ")"

    byte = "list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, z: xor(x >> 1, 3988292384 * (x & 1)))"
    step = f"xor(c >> 8, {byte.replace('xor(c, b)', 'xor(c & 255, b)')})"
    codes = "list_transform(string_split(coalesce(cast(doc_id as varchar), ''), ''), lambda z: cast(ascii(z) as bigint))"
    crc = f"xor(list_reduce(list_prepend(4294967295::bigint, list_filter({codes}, lambda z: z > 0)), lambda c, b: {step}), 4294967295)"
    parts = [
        f"docs as (select *, {leaf('text')} as leaf, case when ({crc}) % 2 = 0 then {leaf("replace(text, chr(10), '')")} else {leaf('text')} end as other from documents)",
        "d as (select *, dense_rank() over (order by source nulls first) as tree, "
        "row_number() over (partition by source order by doc_id nulls first, leaf) - 1 as i, row_number() over () as row from docs)",
        "n0 as (select tree, i, leaf as h from d)",
        "w0 as (select row, tree, i, other as h, '' as proof from d)",
    ]

    def climb(name: str, way: str, k: int) -> None:
        alone = f"(select tree, count(*) = 1 as alone from {name}{k} group by tree)"
        runs = f"select tree, i // 3 as run, list(h order by i) as hs from {name}{k} group by tree, i // 3"
        parts.append(f"{name}r{k} as (select r.*, alone from ({runs}) r join {alone} a on a.tree = r.tree)")
        parts.append(
            f"{name}{k + 1} as (select tree, run as i, case when alone then hs[1] else sha256(array_to_string(hs, '')) end as h from {name}r{k})"
        )
        at = "cast(w.i % 3 as int)"
        left, right = f"array_to_string(hs[1:{at}], '')", f"array_to_string(hs[{at} + 2:3], '')"
        parts.append(
            f"{way}{k + 1} as (select row, w.tree, w.i // 3 as i, case when alone then w.h else sha256({left} || w.h || {right}) end as h, "
            f"case when alone then proof else proof || {left} || {right} end as proof from {way}{k} w join {name}r{k} r on r.tree = w.tree and r.run = w.i // 3)"
        )

    for k in range(levels):
        climb("n", "w", k)
    parts += [
        f"t0 as (select 0 as tree, tree - 1 as i, h from n{levels})",
        f"v0 as (select row, 0 as tree, tree - 1 as i, h, proof from w{levels})",
    ]
    for k in range(top):
        climb("t", "v", k)
    return (
        "with " + ",\n".join(parts) + f"""
select doc_id, leaf, n.h as subroot, t.h as root, sha256(v.proof) as proof_sha256, v.h as folded_root, v.h = t.h as verified
from d join v{top} v using (row) join n{levels} n on n.tree = d.tree cross join t{top} t
"""
    )


@query("op13_manifest", _manifest_sql())
def op13_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest.audited(table(spark, sf_dir, "documents"))


def _lloyd_sql(rounds: int = 3) -> str:
    """One set of tables per round."""
    parts = [
        "v as (select vec_id, row_number() over () as row, list_transform(embedding, lambda x: cast(floor(64 * cast(x as double)) as bigint)) as x "
        "from embeddings where len(embedding) = 64 and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0)",
        "c0 as (select x as c, row_number() over (order by sha256('1:' || coalesce(cast(vec_id as varchar), '')), x) - 1 as cluster "
        "from v order by cluster limit 16)",
    ]
    away = "list_sum(list_transform(range(1, 65), lambda i: (x[i] - c[i]) * (x[i] - c[i])))"
    for k in range(rounds + 1):
        parts.append(f"a{k} as (select row, min(struct_pack(d := {away}, c := cluster)) as near from v cross join c{k} group by row)")
        if k < rounds:
            parts.append(
                f"m{k} as (select near.c as cluster, i, cast(floor(cast(sum(x[i]) as double) / count(*)) as bigint) as m "
                f"from a{k} join v using (row) cross join range(1, 65) as dims(i) group by near.c, i)"
            )
            parts.append(
                f"c{k + 1} as (select cluster, coalesce(ms, c) as c from c{k} left join "
                f"(select cluster, list(m order by i) as ms from m{k} group by cluster) using (cluster))"
            )
    return "with " + ",\n".join(parts) + f"""
select vec_id, cast(near.c as integer) as cluster, cast(near.d as bigint) as distance,
       cast(sum(near.d) over (partition by near.c) as bigint) as cluster_inertia, cast(sum(near.d) over () as bigint) as inertia,
       sha256(array_to_string(c, ',')) as centroid_sha256
from a{rounds} join v using (row) join c{rounds} on cluster = near.c
"""


@query("op11_lloyd", _lloyd_sql())
def op11_lloyd(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lloyd.clustered(table(spark, sf_dir, "embeddings"))

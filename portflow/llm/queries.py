"""The queries of this subpackage, one per operator over its whole table, with SQL where SQL can say the same."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from portflow.llm import ann, bpe, exact_dedup, langid, line_dedup, packing, pieces, prefix_trie, secrets, simhash, token_counts, toxicity, whitening
from portflow.llm.shared import shared_dir, table, text_of, written

OLD, NEW = "words-1", "marks-2"


SHORT_WORDS, MOVED = 20, ("fr", "fr-FR")


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Batches over all documents, whose texts are read and counted once: insert under the old tokenizer; insert under the new
    one, its counts those of the old; revise these to its own counts; delete the old version's documents of fewer than
    SHORT_WORDS words; move one language of the new version to another tag. After a compaction the first and the second
    batch are sent again, as after a lost answer."""
    docs = table(spark, sf_dir, "documents")
    old, new = token_counts.count_tokens(text_of(), OLD), token_counts.count_tokens(text_of(), NEW)
    counts = written(docs.select("source", "lang", old.alias("old_tokens"), new.alias("new_tokens")))
    rollup = token_counts.Rollup(spark, f"{shared_dir(spark)}/rollup-{uuid.uuid4().hex}")
    by = lambda version, n: counts.withColumns({"tokenizer": F.lit(version), "n_tokens": F.col(n)})
    inserted = [token_counts.inserts(by(OLD, "old_tokens")), token_counts.inserts(by(NEW, "old_tokens"))]
    for batch, changes in enumerate(inserted, 1):
        rollup.commit(batch, changes)
    rollup.commit(3, token_counts.revisions(by(NEW, "new_tokens")))
    rollup.commit(4, token_counts.deletes(by(OLD, "old_tokens").where(F.col("old_tokens") < SHORT_WORDS)))
    rollup.compact()
    rollup.commit(5, token_counts.moves(by(NEW, "new_tokens").where(F.col("lang") == MOVED[0]), "lang", F.lit(MOVED[1])))
    for batch, changes in enumerate(inserted, 1):
        rollup.commit(batch, changes)
    return rollup.totals()


OP1_SQL = r"""
with c as (select source, lang, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) as old_tokens,
  len(regexp_extract_all(coalesce(text, ''), '[0-9A-Za-z]+|[^\x20\x09-\x0D0-9A-Za-z]')) as new_tokens from documents)
select source, lang, 'words-1' as tokenizer, count(*) as n_docs, cast(sum(old_tokens) as bigint) as n_tokens from c where old_tokens >= 20 group by source, lang
union all
select source, case lang when 'fr' then 'fr-FR' else lang end, 'marks-2', count(*), cast(sum(new_tokens) as bigint) from c group by 1, 2
"""


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """documents carry no address; their source is their site."""
    docs = table(spark, sf_dir, "documents")
    pages = docs.select(F.col("doc_id").alias("page"), F.col("source").alias("host"), "text")
    out = line_dedup.drop_boilerplate(pages)
    return out.select(
        F.col("page").alias("doc_id"), F.col("host").alias("source"), F.col("n_lines").cast("long"), F.col("n_dropped").cast("long"), F.sha2("text", 256).alias("clean_sha256")
    )


OP2_SQL = r"""
with d as (select doc_id, source, text, string_split(text, chr(10)) as lines from documents),
l as (select doc_id, source, unnest(list_distinct(lines)) as line from d),
n as (select source, count(*) as host_pages from documents group by source),
c as (select source, line, count(*) as pages_with from l where trim(translate(line, chr(9) || chr(13), '  ')) <> '' group by source, line),
b as (select c.source, list(line) as drops from c join n on c.source is not distinct from n.source
      where pages_with >= 2 and pages_with > 0.05 * host_pages group by c.source),
k as (select d.*, list_filter(lines, lambda x: not list_contains(coalesce(drops, []), x)) as kept
      from d left join b on d.source is not distinct from b.source),
r as (select *, len(kept) < len(lines) as cut from k)
select doc_id, source, coalesce(len(lines), 0) as n_lines,
  case when cut then len(lines) - len(kept) else 0 end as n_dropped,
  sha256(case when cut then array_to_string(kept, chr(10)) else text end) as clean_sha256
from r
"""


def op3_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(table(spark, sf_dir, "documents"))


def op4_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.find_secrets(table(spark, sf_dir, "documents"))


def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_groups(table(spark, sf_dir, "documents"))


OP5_SQL = r"""
with d as (select doc_id, length(coalesce(text, '')) as points, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', '', 'g')) as text_sha256 from documents),
w as (select *, first_value(doc_id) over g as keep_id, row_number() over g as nth, count(*) over (partition by text_sha256) as group_size
      from d window g as (partition by text_sha256 order by points desc, doc_id nulls last))
select doc_id, keep_id, group_size, nth = 1 as kept, text_sha256 from w
"""


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = langid.fit_text_model(table(spark, sf_dir, "documents"))
    return langid.identify_pages(table(spark, sf_dir, "pages"), model)


def op8_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest(table(spark, sf_dir, "embeddings"))


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.scored_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whitened_rows(table(spark, sf_dir, "embeddings"))


def op12_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.digests(table(spark, sf_dir, "documents"))


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.prefix_trie(table(spark, sf_dir, "conversations"))


#: The check sum of a decimal number is folded byte by byte and bit by bit, as SQL has no crc32.
OP13_SQL = r"""
with t as (select conv_id as c, coalesce(role, '') as role, coalesce(text, '') as text, turn from conversations where conv_id is not null),
s as (select c, turn, substring(sha256(concat(length(role), ':', role, text)), 1, 32) as t, len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) as w from t),
o as (select c, t, w, row_number() over (partition by c order by turn nulls first, t) as d from s),
v as (select c, c - ((c % 20 + 20) % 20) as base, xor(list_reduce(list_prepend(4294967295::bigint, list_transform(range(1, length(c::varchar) + 1), lambda i: ascii(substring(c::varchar, i, 1))::bigint)),
  lambda a, b: list_reduce(list_prepend(xor(a, b), range(8)), lambda x, k: case when x % 2 = 1 then xor(x // 2, 3988292384) else x // 2 end)), 4294967295::bigint) % 4 as h from (select distinct c from o)),
r as (select v.c, d, t, w from v join o on o.c = v.base where d <= h or v.c = v.base union all select v.c, d, t, w from v join o using (c) where d > h and v.c <> v.base),
l as (select v.c, coalesce(list(t order by d) filter (t is not null), []) as q, coalesce(list(w order by d) filter (t is not null), []) as ws from v left join r using (c) group by v.c),
p as (select c, d, q[1:d] as pre, case when d > 0 then q[1:d - 1] end as par, case when d > 0 then ws[d] else 0 end as w, d = len(q) as ends from l, lateral (select unnest(range(len(q) + 1)) as d)),
n as (select pre, any_value(par) as par, d, min(c) as conv_id, count(*) as n, any_value(w) as w, sha256(coalesce(string_agg(c::varchar, ',' order by c) filter (ends), '')) as ends_sha256 from p group by pre, d),
k as (select par as pre, count(*) as kids from n where d > 0 group by par),
x as (select n.*, coalesce(kids, 0) as kids from n left join k using (pre)),
u as (select pre[1:i] as pre, sum((kids = 0)::int) as leaves, sum((n - 1) * w) as saved from (select pre, kids, n, w, unnest(range(d + 1)) as i from x) group by 1)
select x.conv_id, x.d as depth, y.conv_id as parent_conv_id, x.n as n_convs, x.kids as n_children, cast(u.leaves as bigint) as n_leaves, cast(u.saved as bigint) as saved_tokens, x.ends_sha256
from x join u using (pre) left join x y on y.pre = x.par
"""


QUERIES = {f.__name__: f for f in (op1_token_counts, op2_line_dedup, op3_bpe, op4_secrets, op5_exact_dedup, op6_simhash, op7_language_id, op8_ann, op9_packing, op10_toxicity, op11_whitening, op12_sentencepiece, op13_prefix_trie)}
ORACLE_SQL = {"op1_token_counts": OP1_SQL, "op2_line_dedup": OP2_SQL, "op5_exact_dedup": OP5_SQL, "op13_prefix_trie": OP13_SQL}

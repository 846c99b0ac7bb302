"""The registered queries of this subpackage, with equivalent SQL where SQL can express them."""

from __future__ import annotations

import corpus_pipeline
import public_tokenizers
from pyspark.sql import functions as F

from docgraph.fixtures import table
from docgraph.llm.decontamination import benchmark_passages
from docgraph.llm.divergence import source_divergence
from docgraph.llm.fingerprints import digits, document_fingerprints, likeness, with_near_counts
from docgraph.llm.language import identify_language, train_language_model
from docgraph.llm.license_texts import TEMPLATES
from docgraph.llm.licenses import scan_licenses
from docgraph.llm.near_duplicates import near_duplicates
from docgraph.llm.nearest import top_k
from docgraph.llm.packing import pack_documents
from docgraph.llm.token_counts import token_counts
from docgraph.llm.periodic import collapse_runs
from docgraph.llm.toxicity import score_toxicity, train_toxicity_model
from docgraph.llm.training import held_out
from docgraph.llm.url_filter import judge_urls, url_host
from docgraph.llm.warc import captures, read_captures, write_archives


def op1_warc(spark, sf_dir):
    pages = table(spark, sf_dir, "pages").withColumn("page_id", F.col("page_id").cast("long"))
    found = read_captures(write_archives(pages), pages.select(captures(pages).alias("capture")))
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


# Base32 of the SHA-1: its hexadecimal digits as bits, five bits a letter.
OP1_SQL = """with p as (select page_id, coalesce(html, '') as html, sha1(coalesce(html, '')) as hash from pages),
 b as (select distinct hash, array_to_string(list_transform(string_split(hash, ''), lambda c:
   ['0000','0001','0010','0011','0100','0101','0110','0111','1000','1001','1010','1011','1100','1101','1110','1111'][strpos('0123456789abcdef', c)]), '')
   as bits from p),
 d as (select hash, array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
   1 + 16 * substr(bits, 5 * i::int + 1, 1)::int + 8 * substr(bits, 5 * i::int + 2, 1)::int + 4 * substr(bits, 5 * i::int + 3, 1)::int
   + 2 * substr(bits, 5 * i::int + 4, 1)::int + substr(bits, 5 * i::int + 5, 1)::int, 1)), '') as payload_digest from b),
 k as (select hash, max(page_id) as keeper from p group by hash)
 select page_id, octet_length(encode(html))::bigint as payload_bytes, payload_digest,
  case when page_id < keeper then 'revisit' else 'response' end as record_type, case when page_id < keeper then keeper end as refers_to
 from p join d using (hash) join k using (hash)"""


# The rules on hosts and paths.
URL_RULES = [
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
]

# Hosts of the pages whose third last label is one of these stand for an outside list.
LISTED_NAMES = "ads-track|adult-x|casino-win|cheap-pills|free-bets|spam-farm"


def op2_url_filter(spark, sf_dir):
    pages = table(spark, sf_dir, "pages")
    rules = F.array(*[F.struct(F.lit(h).alias("host"), F.lit(p).alias("path"), F.lit(v).alias("verdict")) for h, p, v in URL_RULES])
    site = F.substring_index(url_host(F.col("url")), ".", -3).alias("host")
    listed = pages.select(site).filter(F.col("host").rlike(rf"^({LISTED_NAMES})\.")).distinct()
    return judge_urls(pages, spark.range(1).select(F.inline(rules)), listed)


OP2_SQL = r"""with rules(host, path, verdict) as (values ('com', '/', 'allow'), ('example.com', '/en/', 'block'),
   ('www.example.com', '/en/', 'allow'), ('net', '/es/', 'block'), ('net', '/fr/', 'block')),
 u as (select page_id, translate(regexp_extract(coalesce(url, ''), '://([^/?#]*)', 1),
   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
   regexp_extract(coalesce(url, ''), '://[^/?#]*([^?#]*)', 1) as path from pages),
 fit as (select u.host, u.path, max_by(r.host || r.path, length(r.host || r.path)) as rule,
   max_by(r.verdict, length(r.host || r.path)) as verdict
   from (select distinct host, path from u) u join rules r on (u.host = r.host or u.host like '%.' || r.host) and starts_with(u.path, r.path)
   group by all)
 select page_id, u.host, u.path, rule, coalesce(verdict, case when regexp_matches(u.host,
   '(^|\.)(ads-track|adult-x|casino-win|cheap-pills|free-bets|spam-farm)\.[^.]*\.[^.]*$') then 'block' else 'allow' end) as verdict
 from u left join fit on u.host = fit.host and u.path = fit.path"""


def op4_near_duplicates(spark, sf_dir):
    found = near_duplicates(table(spark, sf_dir, "documents"), shingle_words=3, percent=85)
    return found.select("doc_id", "n_shingles", "component_id", "kept")


OP4_SQL = r"""with recursive w as (
   select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
     '[^\x20\x09-\x0D]+') as words from documents),
 s as (select doc_id, list_distinct(case when len(words) = 0 then [] when len(words) < 3 then [array_to_string(words, ' ')]
   else list_transform(range(1, len(words) - 1), lambda i: words[i] || ' ' || words[i + 1] || ' ' || words[i + 2]) end) as shingles from w),
 n as (select doc_id, len(shingles) as n from s),
 e as (select doc_id, unnest(shingles) as shingle from s),
 common as (select a.doc_id as a, b.doc_id as b, count(*) as c from e a join e b on a.shingle = b.shingle and a.doc_id < b.doc_id group by all),
 link as (select a, b from common join n x on x.doc_id = a join n y on y.doc_id = b where 100 * c >= 85 * (x.n + y.n - c)),
 both_ways as (select a, b from link union all select b, a from link),
 reach(doc_id, other) as (select doc_id, doc_id from n union select r.doc_id, l.b from reach r join both_ways l on l.a = r.other),
 root as (select doc_id, min(other) as component_id from reach group by doc_id)
 select n.doc_id, n.n as n_shingles, component_id, n.doc_id = component_id as kept from n join root using (doc_id)"""


def op6_language_id(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    told = identify_language(docs.select("doc_id", "text"), train_language_model(docs))
    return told.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", "lang_accepted")


def op7_toxicity(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    told = score_toxicity(docs, train_toxicity_model(docs, table(spark, sf_dir, "labels")))
    return told.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


# Fixed value: the end-of-document id of the tokenizer.
END_OF_TEXT = 49407


def op9_token_counts(spark, sf_dir):
    return token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), END_OF_TEXT)


def op10_packing(spark, sf_dir):
    return pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op8_decontamination(spark, sf_dir):
    """A row per passage of a benchmark item in a document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = benchmark_passages(docs, table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", F.inline("passages"))


def op5_nearest(spark, sf_dir):
    return top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, k=10)


OP5_SQL = """with v as (select vec_id, list_transform(embedding, lambda x: floor(x::double * 1024)) as v from embeddings),
 s as (select q.vec_id as query_id, d.vec_id, list_dot_product(q.v, d.v)::bigint as score
   from v q join v d on q.vec_id % 100 = 0 and d.vec_id <> q.vec_id)
 select query_id, cast(row_number() over w as integer) as rank, vec_id, score from s
 window w as (partition by query_id order by score desc, vec_id) qualify row_number() over w <= 10"""


def op3_license_scan(spark, sf_dir):
    """A row per license template found in a document."""
    texts = F.create_map(*[F.lit(x) for pair in TEMPLATES.items() for x in pair])
    templates = spark.range(1).select(F.explode(texts).alias("template_id", "text"))
    found = scan_licenses(table(spark, sf_dir, "documents").select("doc_id", "text"), templates)
    return found.select("doc_id", F.inline("licenses"))


def op11_source_divergence(spark, sf_dir):
    return source_divergence(table(spark, sf_dir, "documents"))


OP11_SQL = r"""with d as (select coalesce(lang, '') as lang, coalesce(source, '') as source, row_number() over () as doc,
   regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
     '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') as terms from documents),
 e as (select lang, source, doc, unnest(terms) as term from d),
 kept as (select lang, term, count(*) as in_lang from e group by all having count(distinct doc) >= 10),
 v as (select lang, count(*) as v, sum(in_lang) as n from kept group by lang),
 grp as (select distinct lang, source from d),
 c as (select g.lang, g.source, k.term, k.in_lang, count(e.term) as c
   from grp g join kept k on k.lang = g.lang left join e on e.lang = g.lang and e.source = g.source and e.term = k.term group by all),
 n as (select lang, source, sum(c) as n from c group by all),
 p as (select c.lang, c.source, c.term, c.c, 1 + (1000000000::hugeint * (c.c + 2)) // (n.n + 2 * v.v)::hugeint as p,
   1 + (1000000000::hugeint * (c.in_lang + 2)) // (v.n + 2 * v.v)::hugeint as q from c join n using (lang, source) join v on v.lang = c.lang),
 apart as (select a.lang, a.source, b.source as item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) as value
   from p a join p b on a.lang = b.lang and a.term = b.term and a.source <> b.source group by all),
 pairs as (select a.lang, a.source, 'pair' as part, b.source as item, coalesce(x.value, 0)::bigint as value from grp a
   join grp b on a.lang = b.lang and a.source <> b.source
   left join apart x on x.lang = a.lang and x.source = a.source and x.item = b.source),
 terms as (select lang, source, 'term' as part, term as item, ((p - q) * (p - q) // (p + q))::bigint as value from p where c > 0 and p > q),
 ranked as (select *, (row_number() over (partition by lang, source, part order by value desc, item))::integer as rank
   from (select * from pairs union all select * from terms))
 select lang, source, part, item, value, rank from ranked where part = 'pair' or rank <= 10"""


def op12_fingerprints(spark, sf_dir):
    """Every document; ``near_docs`` counts the others within three bits of those whose id is divisible by 20."""
    found = document_fingerprints(table(spark, sf_dir, "documents"))
    found = with_near_counts(found, F.col("doc_id") % 20 == 0)
    told = [digits("simhash").alias("fingerprint"), digits("edited").alias("edited_fingerprint")]
    near = [likeness("simhash", "edited").alias("near_edited"), likeness("simhash", "following").alias("near_next")]
    return found.select("doc_id", "n_chars", "edited_sha256", *told, *near, "near_docs")


def op13_periodic_runs(spark, sf_dir):
    # Every tenth document repeats a stretch of its own words from some word on.
    h, words = F.crc32(F.col("doc_id").cast("string")), F.filter(F.split(F.coalesce("text", F.lit("")), r"[\x20\x09-\x0D]+", -1), lambda w: w != "")
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", h.alias("h"), F.when(h % 10 == 0, words).alias("words"))
    docs = docs.withColumn("n", F.size("words")).withColumn("g", F.floor(F.col("h") / 10)).withColumn("a", F.expr("if(n > 0, g % n, 0)"))
    docs = docs.withColumn("p", F.expr("1 + (n - a) div (3 + g % 8)"))
    repeated = F.expr("array_join(transform(words, (w, i) -> if(i < a, w, words[cast(a + (i - a) % p as int)])), ' ')")
    found = collapse_runs(docs.select("doc_id", F.when(F.col("n") > 0, repeated).otherwise(F.col("text")).alias("text")))
    # Fractions are compared by cross products, so that no rounding decides.
    better = "(b.length * r.period > r.length * b.period or b.length * r.period = r.length * b.period and (b.start < r.start or b.start = r.start and b.period < r.period))"
    best = F.expr(f"reduce(runs, runs[0], (b, r) -> if({better}, b, r))")
    lines = F.transform("runs", lambda r: F.concat(r["start"].cast("string"), F.lit(","), r["length"].cast("string"), F.lit(","), r["period"].cast("string"), F.lit("\n")))
    found = found.withColumn("best", F.when(F.size("runs") > 0, best))
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        "best.start",
        "best.length",
        "best.period",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


QUERIES = {
    "op1_warc": (op1_warc, OP1_SQL),
    "op2_url_filter": (op2_url_filter, OP2_SQL),
    "op4_near_duplicates": (op4_near_duplicates, OP4_SQL),
    "op3_license_scan": (op3_license_scan, None),
    "op5_nearest": (op5_nearest, OP5_SQL),
    "op6_language_id": (op6_language_id, None),
    "op7_toxicity": (op7_toxicity, None),
    "op9_token_counts": (op9_token_counts, None),
    "op10_packing": (op10_packing, None),
    "pipeline": (corpus_pipeline.run, corpus_pipeline.ORACLE_SQL),
    "op8_decontamination": (op8_decontamination, None),
    "op11_source_divergence": (op11_source_divergence, OP11_SQL),
    "op12_fingerprints": (op12_fingerprints, None),
    "op13_periodic_runs": (op13_periodic_runs, None),
}

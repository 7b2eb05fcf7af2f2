"""Registered text queries (TX1-TX15, A5, J3, J9)."""

from __future__ import annotations

from pyspark.sql import functions as F

from quarry.functions import text as TF
from quarry.operators import text as TX
from quarry.plans.registry import query
from quarry.sources.tables import table

VOCAB = 1000


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _sql_html_to_text(c: str) -> str:
    t = f"regexp_replace({c}, {_q(TF.HEAD_RE)}, '', 'g')"
    t = f"regexp_replace({t}, {_q(TF.LINK_RE)}, ' HYPERLINK ', 'g')"
    t = f"regexp_replace({t}, {_q(TF.TAG_RE)}, '', 'g')"
    t = f"regexp_replace({t}, {_q(TF.NEWLINES_RE)}, chr(10), 'g')"
    for ent, ch in TF.ENTITIES:
        t = f"replace({t}, {_q(ent)}, {_q(ch)})"
    return t


def _sql_normalize(c: str) -> str:
    t = f"lower({c})"
    t = f"regexp_replace({t}, {_q(TF.URL_RE)}, ' URL ', 'g')"
    t = f"regexp_replace({t}, {_q(TF.NUMBER_RE)}, 'NUMBER', 'g')"
    return f"regexp_replace({t}, {_q(TF.PUNCT_RE)}, ' ', 'g')"


def _sql_tokens(c: str) -> str:
    return f"list_filter(regexp_split_to_array({c}, {_q(TF.WS_RE)}), lambda x: x <> '')"


WC_SQL = f"""wc AS (
  SELECT doc_id, word, count(*) AS count FROM (
    SELECT doc_id, unnest({_sql_tokens(_sql_normalize('text'))}) AS word FROM documents)
  GROUP BY doc_id, word)"""

VOCAB_SQL = f"""{WC_SQL},
vocab AS (
  SELECT word, total, row_number() OVER (ORDER BY total DESC, word)::INTEGER AS idx FROM (
    SELECT word, sum(least(count, 10)) AS total FROM wc GROUP BY word)
  ORDER BY total DESC, word LIMIT {VOCAB})"""


def _word_counts(spark, sf, stemming=False):
    d = table(spark, sf, "documents").select("doc_id", "text")
    return TX.word_counts(d, "doc_id", "text", stemming=stemming)


@query("tx1_html_to_text", f"SELECT page_id, {_sql_html_to_text('html')} AS text FROM pages")
def tx1_html_to_text(spark, sf):
    p = table(spark, sf, "pages").select("page_id", "html")
    return p.select("page_id", TF.html_to_text("html").alias("text"))


@query("tx1b_html_unescape_full")
def tx1b_html_unescape_full(spark, sf):
    p = table(spark, sf, "pages").select("page_id", "html")
    return p.select("page_id", TX.html_unescape_full(TF.html_to_text("html", unescape=False))
                    .alias("text"))


def _mails(spark, sf):
    """RFC 822 messages built from the given tables: plain (documents),
    HTML (pages) and multipart/alternative (conversation turns)."""
    nl = F.lit("\n")
    docs = table(spark, sf, "documents").select(
        F.concat(F.lit("doc-"), F.col("doc_id").cast("string")).alias("mail_id"),
        F.concat(F.lit("Subject: document "), F.col("doc_id").cast("string"), nl,
                 F.lit("Content-Type: text/plain; charset=utf-8"), nl,
                 F.lit("Content-Transfer-Encoding: 8bit"), nl, nl, F.col("text")).alias("raw"))
    pages = table(spark, sf, "pages").select(
        F.concat(F.lit("page-"), F.col("page_id").cast("string")).alias("mail_id"),
        F.concat(F.lit("Subject: page "), F.col("url"), nl,
                 F.lit("Content-Type: text/html; charset=utf-8"), nl,
                 F.lit("Content-Transfer-Encoding: 8bit"), nl, nl, F.col("html")).alias("raw"))
    conv = table(spark, sf, "conversations")
    b = F.lit("==b==")
    multi = conv.select(
        F.concat(F.lit("conv-"), F.col("conv_id").cast("string"), F.lit("-"),
                 F.col("turn").cast("string")).alias("mail_id"),
        F.concat(F.lit("Subject: turn by "), F.col("role"), nl, F.lit("MIME-Version: 1.0"), nl,
                 F.lit('Content-Type: multipart/alternative; boundary="==b=="'), nl, nl,
                 F.lit("--"), b, nl, F.lit("Content-Type: text/plain; charset=utf-8"), nl,
                 F.lit("Content-Transfer-Encoding: 8bit"), nl, nl, F.col("text"), nl,
                 F.lit("--"), b, nl, F.lit("Content-Type: text/html; charset=utf-8"), nl,
                 F.lit("Content-Transfer-Encoding: 8bit"), nl, nl,
                 F.lit("<html><body><p>"), F.col("text"), F.lit("</p></body></html>"), nl,
                 F.lit("--"), b, F.lit("--"), nl).alias("raw"))
    allm = docs.unionByName(pages).unionByName(multi)
    return TX.parse_mails(allm.withColumn("content", F.encode("raw", "UTF-8")).drop("raw"))


_MAIL_SQL = """mails AS (
  SELECT 'doc-' || CAST(doc_id AS VARCHAR) AS mail_id, 'text/plain' AS structure,
         'document ' || CAST(doc_id AS VARCHAR) AS subject FROM documents
  UNION ALL
  SELECT 'page-' || CAST(page_id AS VARCHAR), 'text/html', 'page ' || url FROM pages
  UNION ALL
  SELECT 'conv-' || CAST(conv_id AS VARCHAR) || '-' || CAST(turn AS VARCHAR),
         'multipart(text/plain, text/html)', 'turn by ' || role FROM conversations)"""


@query("tx2_email_structure", f"WITH {_MAIL_SQL} SELECT mail_id, structure FROM mails")
def tx2_email_structure(spark, sf):
    return _mails(spark, sf).select("mail_id", "structure")


@query("tx3_email_to_text", f"""
SELECT 'doc-' || CAST(doc_id AS VARCHAR) AS mail_id, text FROM documents
UNION ALL
SELECT 'page-' || CAST(page_id AS VARCHAR), {_sql_html_to_text('html')} FROM pages
UNION ALL
SELECT 'conv-' || CAST(conv_id AS VARCHAR) || '-' || CAST(turn AS VARCHAR), text FROM conversations""")
def tx3_email_to_text(spark, sf):
    return _mails(spark, sf).select("mail_id", "text")


@query("tx4_email_header", f"WITH {_MAIL_SQL} SELECT mail_id, subject FROM mails")
def tx4_email_header(spark, sf):
    return _mails(spark, sf).select("mail_id", "subject")


@query("tx5_structure_counts", f"""WITH {_MAIL_SQL}
SELECT structure, count(*) AS count FROM mails GROUP BY structure
ORDER BY count DESC, structure LIMIT 10""")
def tx5_structure_counts(spark, sf):
    return TX.structure_counts(_mails(spark, sf))


@query("tx6_lower", "SELECT doc_id, lower(text) AS text FROM documents")
def tx6_lower(spark, sf):
    d = table(spark, sf, "documents")
    return d.select("doc_id", TF.lower("text").alias("text"))


@query("tx7_replace_urls", f"""
SELECT page_id, regexp_replace(html, {_q(TF.URL_RE)}, ' URL ', 'g') AS text FROM pages""")
def tx7_replace_urls(spark, sf):
    p = table(spark, sf, "pages")
    return p.select("page_id", TF.replace_urls("html").alias("text"))


@query("tx8_replace_numbers", f"""
SELECT doc_id, length(t)::INTEGER AS len, md5(t) AS digest FROM (
  SELECT doc_id, regexp_replace(text, {_q(TF.NUMBER_RE)}, 'NUMBER', 'g') AS t FROM documents)""")
def tx8_replace_numbers(spark, sf):
    d = table(spark, sf, "documents").select("doc_id", TF.replace_numbers("text").alias("t"))
    return d.select("doc_id", F.length("t").alias("len"), F.md5("t").alias("digest"))


@query("tx9_strip_punctuation", f"""
SELECT doc_id, length(t)::INTEGER AS len, md5(t) AS digest FROM (
  SELECT doc_id, regexp_replace(text, {_q(TF.PUNCT_RE)}, ' ', 'g') AS t FROM documents)""")
def tx9_strip_punctuation(spark, sf):
    d = table(spark, sf, "documents").select("doc_id", TF.strip_punctuation("text").alias("t"))
    return d.select("doc_id", F.length("t").alias("len"), F.md5("t").alias("digest"))


@query("tx10_tokenize", f"""
SELECT doc_id, len(w)::INTEGER AS n_tokens, md5(array_to_string(w, ' ')) AS digest FROM (
  SELECT doc_id, {_sql_tokens('text')} AS w FROM documents)""")
def tx10_tokenize(spark, sf):
    d = table(spark, sf, "documents").select("doc_id", TF.tokens("text").alias("w"))
    return d.select("doc_id", F.size("w").alias("n_tokens"),
                    F.md5(F.concat_ws(" ", "w")).alias("digest"))


@query("tx11_stem_counts")
def tx11_stem_counts(spark, sf):
    return _word_counts(spark, sf, stemming=True)


@query("tx12_word_counts", f"WITH {WC_SQL} SELECT doc_id, word, count FROM wc")
def tx12_word_counts(spark, sf):
    return _word_counts(spark, sf)


@query("a5_capped_sum", f"""WITH {WC_SQL}
SELECT word, sum(least(count, 10))::BIGINT AS total FROM wc GROUP BY word""")
def a5_capped_sum(spark, sf):
    from quarry.operators.aggregate import capped_sum
    return capped_sum(_word_counts(spark, sf), ["word"], "count", 10)


@query("tx13_fit_vocabulary", f"WITH {VOCAB_SQL} SELECT word, total::BIGINT AS total, idx FROM vocab")
def tx13_fit_vocabulary(spark, sf):
    return TX.fit_vocabulary(_word_counts(spark, sf), VOCAB)


@query("j3_vocabulary_lookup", f"""WITH {VOCAB_SQL}
SELECT w.word, coalesce(v.idx, 0)::INTEGER AS idx
FROM (SELECT DISTINCT word FROM wc) w LEFT JOIN vocab v ON w.word = v.word""")
def j3_vocabulary_lookup(spark, sf):
    from quarry.operators.joins import vocabulary_lookup
    from quarry.operators.aggregate import capped_sum
    from quarry.session import cut_lineage
    totals = cut_lineage(capped_sum(_word_counts(spark, sf), ["word"], "count", 10))    # a row per word; one scan of the texts
    return vocabulary_lookup(totals.select("word"), TX.top_words(totals, VOCAB)).select("word", "idx")


@query("tx14_counts_to_vector", f"""WITH {VOCAB_SQL}
SELECT doc_id, coalesce(v.idx, 0)::INTEGER AS idx, sum(count)::BIGINT AS count
FROM wc LEFT JOIN vocab v USING (word) GROUP BY 1, 2""")
def tx14_counts_to_vector(spark, sf):
    wc = _word_counts(spark, sf)
    return TX.counts_to_long(wc, TX.fit_vocabulary(wc, VOCAB), "doc_id")


@query("j9_stem_lookup")
def j9_stem_lookup(spark, sf):
    wc = _word_counts(spark, sf)
    vocab = wc.select("word").distinct()
    return vocab.withColumn("stem", TX.porter_stem(F.col("word")))


@query("tx15_currency_label", """
SELECT o_orderkey, printf('$%dk', CAST(trunc(o_totalprice / 1000) AS INTEGER)) AS label FROM orders""")
def tx15_currency_label(spark, sf):
    o = table(spark, sf, "orders")
    return o.select("o_orderkey", TF.currency_label("o_totalprice").alias("label"))

"""Queries of quotation extraction over documents and boxes, with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagewright.functions import text as X
from pagewright.operators import quotes as Q
from pagewright.session import table

#: The speakers of the project's texts, and the verbs that introduce their words.
SPEAKERS = "书记员|老馆长|译者|审校人|执行法官|值班员|测量员|队长|乡长|会计|教师|编者|记录员|一位渡工"
ONE, VERBS = "书记员", ["写道", "反问", "说", "指出", "问道"]


def _documents(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "documents").filter("text is not null")


def quote_candidates(spark: SparkSession, sf: str) -> DataFrame:
    rules = Q.Rules(SPEAKERS, (*Q.CUES, "反问", "问道"))
    return Q.candidates(_documents(spark, sf), "doc_id", "text", rules)


def sentence_quotes(spark: SparkSession, sf: str) -> DataFrame:
    return Q.sentence_quotes(_documents(spark, sf), "doc_id", "text", ONE, VERBS)


def _per_book(spark: SparkSession, sf: str) -> DataFrame:
    rows = Q.sentence_quotes(_documents(spark, sf), "doc_id", "text", ONE, VERBS)
    return rows.join(_documents(spark, sf).select("doc_id", "doc_key"), "doc_id").select("doc_key", "doc_id", "sentence_no", "quote_no", "quote")


def quote_distinct(spark: SparkSession, sf: str) -> DataFrame:
    """The first quotation of a book for each text without punctuation."""
    return Q.distinct_by(_per_book(spark, sf), ["doc_key"], X.no_punctuation(F.col("quote")), ["doc_id", "sentence_no", "quote_no"])


def substring_quote_dedup(spark: SparkSession, sf: str) -> DataFrame:
    """Quotations of a book that no longer one contains."""
    return Q.without_contained(_per_book(spark, sf), ["doc_key"], "quote", ["doc_id", "sentence_no", "quote_no"])


def quote_summary(spark: SparkSession, sf: str) -> DataFrame:
    per = Q.sentence_quotes(_documents(spark, sf), "doc_id", "text", ONE, VERBS)
    found = per.withColumnRenamed("quote", "text").withColumn("type", F.lit("direct"))
    r = Q.results(found, ["doc_id"], ONE, ["sentence_no", "quote_no"])
    return r.select("doc_id", "status", F.col("data.summary.total_quotes").cast("bigint").alias("total_quotes"), F.array_join(F.transform(F.get("data.people", F.lit(0))["quotes"], lambda q: q["text"]), "|").alias("quotes"))


def answer_validator(spark: SparkSession, sf: str) -> DataFrame:
    """Which answers hold against a text: the quotations of each document, as one answer, against its own text and against that
    of the next document that has some."""
    d = _documents(spark, sf)
    per = Q.sentence_quotes(d, "doc_id", "text", ONE, VERBS).groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct("sentence_no", "quote_no", "quote"))).alias("x"))
    people = F.array(F.struct(F.lit(ONE).alias("name"), F.transform("x", lambda q: F.struct(q["quote"].alias("text"))).alias("quotes")))
    answers = per.select("doc_id", F.concat(F.lit("answer: "), F.to_json(F.struct(F.struct(people.alias("people")).alias("data"))), F.lit(" end")).alias("answer"))
    own = answers.join(d.select("doc_id", "text"), "doc_id").withColumn("source", F.lit("own"))
    other = answers.join(d.select((F.col("doc_id") - 1).alias("doc_id"), "text"), "doc_id").withColumn("source", F.lit("next"))
    return Q.valid_answers(own.unionByName(other), "answer", "text").select("doc_id", "source", "valid")


def speaker_lines(spark: SparkSession, sf: str) -> DataFrame:
    """Lines with the speaker and a quotation closed by a circled note."""
    lines = _documents(spark, sf).select("doc_id", F.posexplode(F.split("text", "\n")).alias("line_no", "line"))
    kept = lines.filter(F.contains("line", F.lit(ONE)) & F.col("line").rlike("[\"”][^①-⑳]*[①-⑳]"))
    return kept.select("doc_id", F.col("line_no").cast("bigint").alias("line_no"), F.md5("line").alias("line"))


def queries() -> dict:
    own = (quote_candidates, sentence_quotes, quote_distinct, substring_quote_dedup, quote_summary, answer_validator, speaker_lines)
    return {f.__name__: f for f in own}


def quotes_sql(verbs: list[str], n: str = "") -> str:
    """Quotations of ``ONE`` near one of the verbs, as r (tables with the suffix ``n``)."""
    near = " or ".join(f"contains(left(c, 50), '{v}')" for v in verbs)
    return f"""with d{n} as (select doc_id, doc_key, regexp_extract_all(text, '([^。！？]*[。！？]|[^。！？]+$)') ss from documents where text is not null and contains(text, '{ONE}')),
s{n} as (select doc_id, doc_key, unnest(ss) s, generate_subscripts(ss, 1) - 1 sentence_no from d{n}),
c{n} as (select *, substr(s, instr(s, '{ONE}')) c from s{n} where contains(s, '{ONE}')),
q{n} as (select *, list_filter(regexp_extract_all(c, '["“]([^"”]+)["”]', 1), lambda q: length(q) > 2) qs from c{n} where {near}),
r{n} as (select doc_id, doc_key, sentence_no, unnest(qs) quote, generate_subscripts(qs, 1) - 1 quote_no, case when length(s) > 50 then left(s, 50) || '...' else s end context from q{n})
"""


def oracle_sql() -> dict[str, str]:
    sq = quotes_sql(VERBS)
    return {
        "sentence_quotes": sq + "select doc_id, sentence_no, quote_no, quote, context from r",
        "quote_distinct": sq + ", n as (select *, row_number() over (partition by doc_key, regexp_replace(quote, '[^\\p{L}\\p{N}_\\s]', '', 'g') order by doc_id, sentence_no, quote_no) n from r) select doc_key, doc_id, sentence_no, quote_no, quote from n where n = 1",
        "substring_quote_dedup": sq + """, k as (select *, regexp_replace(quote, '[^\\p{L}\\p{N}_]', '', 'g') cl from r)
select doc_key, doc_id, sentence_no, quote_no, quote from k a where not exists (select 1 from k b where b.doc_key is not distinct from a.doc_key and contains(b.cl, a.cl)
and (length(b.cl) > length(a.cl) or (b.cl = a.cl and (b.doc_id, b.sentence_no, b.quote_no) < (a.doc_id, a.sentence_no, a.quote_no))))""",
        "quote_summary": sq + "select doc_id, 'success' status, count(*) total_quotes, string_agg(quote, '|' order by sentence_no, quote_no) quotes from r group by doc_id",
        "answer_validator": sq + """, a as (select doc_id, list(quote) l from r group by doc_id),
x as (select a.doc_id, 'own' source, l, t.text tx from a join documents t using (doc_id) union all select a.doc_id, 'next', l, t.text from a join documents t on t.doc_id = a.doc_id + 1 where t.text is not null)
select doc_id, source, contains(tx, '书记员') and len(list_filter(l, lambda q: not contains(tx, q))) = 0 valid from x""",
        "speaker_lines": f"with l as (select doc_id, unnest(string_split(text, chr(10))) line, generate_subscripts(string_split(text, chr(10)), 1) - 1 line_no from documents where text is not null) select doc_id, line_no, md5(line) line from l where contains(line, '{ONE}') and regexp_matches(line, '[\"”][^①-⑳]*[①-⑳]')",
    }

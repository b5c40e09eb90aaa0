"""Rule-based extraction of quotations, optional adjudication by a model, checks and de-duplication."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagewright.functions import text as X

# Verbs that introduce a quotation, patterns that do, and pairs of quotation marks.
CUE_PATTERNS = ("在.*?讲话", "在.*?强调")
CUES = "指出 强调 明确 表示 提出 认为 说 称 谈到 写道 要求 号召 重申 阐明 部署 提出要求 作出指示 作出重要指示 作出重要论述 作出重要讲话 发表重要讲话".split()
MARKS = (("“", "”"), ('"', '"'), ("「", "」"), ("『", "』"))
CANDIDATE = "id string, text string, start bigint, `end` bigint, cue string, speaker string, context string, source string"


@dataclass(frozen=True)
class Rules:
    """What makes a candidate: the speaker (a pattern), the cues (literal, then as patterns), context widths."""

    speaker: str
    cues: tuple[str, ...] = tuple(CUES)
    patterns: tuple[str, ...] = CUE_PATTERNS
    left: int = 120
    around: int = 80

    def cue_pattern(self) -> str:
        return "|".join(sorted([*map(regex.escape, self.cues), *self.patterns], key=len, reverse=True))


_NOTES = regex.compile(r"(?:[①-⑳]+)$")
_BRACKETS = regex.compile(r"(?:\[\d+\]|（\d+）|\(\d+\))+$")
_COMMAS = regex.compile(r"[，,;；:：]+$")


def strip_references(text: str) -> str:
    for pattern in (_NOTES, _BRACKETS, _COMMAS):
        text = pattern.sub("", text.strip())
    return text.strip()


def candidates_of(text: str, rules: Rules) -> list[tuple]:
    """Candidates of one text in order of place; of equal ones the place is the first, the source the last."""
    cue, who = rules.cue_pattern(), f"({rules.speaker})"
    found: dict[tuple, tuple] = {}

    def add(name: str, start: int, raw: str, cue_: str, speaker: str, source: str) -> bool:
        own = strip_references(raw)
        if own:
            end = start + len(own)
            context = text[max(0, start - rules.around) : min(len(text), end + rules.around)]
            found[start, end, own] = (name, own, start, end, cue_, speaker, context, source)
        return bool(own)

    spans = sorted(m.span(1) for a, b in MARKS for m in regex.finditer(f"{regex.escape(a)}([^{regex.escape(b)}]{{2,2000}}){regex.escape(b)}", text))
    for i, (a, b) in enumerate(spans):
        before = text[max(0, a - rules.left) : a]
        speakers, cues = regex.findall(who, before), regex.findall(f"({cue})", before)
        if speakers and cues:
            add(f"Q{i}", a, text[a:b], cues[-1], speakers[-1] if isinstance(speakers[-1], str) else speakers[-1][0], "quoted")
    for letter, source, link, most in (("C", "colon", r".{0,20}?[：:]", 500), ("N", "noquote", r"[，, ]*", 260)):
        n = 0
        for m in regex.finditer(rf"(?P<who>{rules.speaker}).{{0,40}}?(?P<cue>{cue}){link}(?P<said>[^。！？；\n]{{6,{most}}})", text):
            n += add(f"{letter}{n}", m.start("said"), m.group("said"), m.group("cue"), m.group("who"), source)
    return sorted(found.values(), key=lambda c: (c[2], c[3]))


def candidates(df: DataFrame, key: str, text: str, rules: Rules) -> DataFrame:
    """Candidates of all texts: key and the candidate's fields. Texts without the speaker never leave the JVM."""
    source = df.filter(F.col(text).rlike(rules.speaker)).select(F.col(key).alias("k"), F.col(text).alias("t"))
    names = [f.split()[0].strip("`") for f in CANDIDATE.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [(i, *c) for i, t in enumerate(batch.column(1).to_pylist()) for c in candidates_of(t, rules)]
            if rows:
                c = list(zip(*rows))
                kinds = [pa.string(), pa.string(), pa.int64(), pa.int64(), *[pa.string()] * 4]
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(c[0])), *[pa.array(x, k) for x, k in zip(c[1:], kinds)]], names=["k", *names])

    out = source.mapInArrow(run, f"k {df.schema[key].dataType.simpleString()}, {CANDIDATE}")
    return out.withColumnRenamed("k", key)


def sentence_quotes(df: DataFrame, key: str, text: str, speaker: str, verbs: list[str], near: int = 50) -> DataFrame:
    """Quotations in sentences that name the speaker with a verb near the name: key, sentence_no, quote_no, quote, context."""
    sentences = F.regexp_extract_all(text, F.lit("([^。！？]*[。！？]|[^。！？]+$)"), F.lit(1))
    s = df.filter(F.contains(text, F.lit(speaker))).select(F.col(key), F.posexplode(sentences).alias("sentence_no", "s")).filter(F.contains("s", F.lit(speaker)))
    said = s.withColumn("c", F.expr(f"substring(s, locate('{speaker}', s))"))
    verb = F.exists(F.array(*[F.lit(v) for v in verbs]), lambda v: F.contains(F.left("c", F.lit(near)), v))
    quotes = F.filter(F.regexp_extract_all("c", F.lit("[\"“]([^\"”]+)[\"”]"), F.lit(1)), lambda q: F.length(q) > 2)
    rows = said.filter(verb).select(key, "sentence_no", X.shorten(F.col("s"), 50).alias("context"), F.posexplode(quotes).alias("quote_no", "quote"))
    return rows.select(key, F.col("sentence_no").cast("bigint").alias("sentence_no"), F.col("quote_no").cast("bigint").alias("quote_no"), "quote", "context")


def distinct_by(df: DataFrame, key: list[str], clean: Column, order: list[str]) -> DataFrame:
    """The first row of each clean text."""
    keyed = df.withColumn("__clean", clean)
    first = keyed.groupBy(*key, "__clean").agg(F.min_by(F.struct(*df.columns), F.struct(*order)).alias("r"))
    return first.select("r.*")


def without_contained(quotes: DataFrame, key: list[str], text: str, order: list[str]) -> DataFrame:
    """Quotations that no longer one of their document contains (punctuation aside); of equal ones the first stays.

    A contained text shares its first characters with its container. Hashes of the first characters (6, or the 2 or 1 of
    shorter texts) of the distinct texts are joined to those of all places of the others, by document; only the pairs that
    share one fetch texts. A text without letters is contained in any other of its document.
    """
    # documents as a struct, whose null fields are equal, so that joins are by name
    rows = quotes.withColumns({"__d": F.struct(*key), "__c": X.no_punctuation(F.col(text), keep_blanks=False), "__o": F.struct(*order)})
    # one row for each document and text: of equal ones the first
    distinct = rows.groupBy("__d", "__c").agg(F.min("__o").alias("__o")).withColumns({"id": F.xxhash64("__c"), "n": F.length("__c")})
    texts = distinct.select("__d", "id", "__c")
    k = F.when(F.col("n") >= 6, 6).when(F.col("n") >= 2, 2).otherwise(1)
    small = distinct.filter("n > 0").select("__d", F.col("id").alias("small_id"), F.col("n").alias("small_n"), k.alias("k"), F.xxhash64(F.left("__c", k)).alias("g"))
    sized = distinct.join(small.select("__d", "k").distinct(), "__d").filter("n >= k")
    at = F.array_distinct(F.transform(F.sequence(F.lit(1), F.col("n") - F.col("k") + 1), lambda i: F.xxhash64(F.substr("__c", i, F.col("k")))))
    large = sized.select("__d", "k", F.col("id").alias("large_id"), F.col("n").alias("large_n"), F.explode(at).alias("g"))
    pairs = small.join(large, ["__d", "k", "g"]).filter("large_n > small_n").select("__d", "small_id", "large_id").distinct()
    named = lambda name: texts.withColumnsRenamed({"id": f"{name}_id", "__c": f"{name}_c"})
    held = pairs.join(named("small"), ["__d", "small_id"]).join(named("large"), ["__d", "large_id"]).filter(F.contains("large_c", F.col("small_c"))).select("__d", F.col("small_id").alias("id")).distinct()
    # a text without letters goes where any other is
    filled = distinct.filter("n > 0").select("__d").distinct()
    gone = held.unionByName(distinct.filter("n = 0").join(filled, "__d", "left_semi").select("__d", "id"))
    kept = distinct.join(gone, ["__d", "id"], "left_anti").select("__d", "__o")
    return rows.join(kept, ["__d", "__o"], "left_semi").select(*quotes.columns)


def adjudicated(candidates_: DataFrame, verdicts: DataFrame, key: list[str]) -> DataFrame:
    """Candidates that a model keeps: verdicts have the key, id, keep, text, type; the model's text stands if not empty."""
    joined = candidates_.join(verdicts.filter("keep").select(*key, "id", F.col("text").alias("__v"), "type"), [*key, "id"])
    text = F.coalesce(F.nullif(X.strip(F.col("__v")), F.lit("")), F.col("text"))
    return joined.withColumn("text", text).drop("__v").filter(F.col("text") != "")


def results(quotes: DataFrame, key: list[str], name: str, order: list[str]) -> DataFrame:
    """Nested result per document: message, status and data (people with quotes, summary)."""
    one = F.struct(F.col("text"), F.coalesce(F.col("type"), F.lit("direct")).alias("type"), F.col("context"))
    grouped = quotes.groupBy(*key).agg(F.array_sort(F.collect_list(F.struct(*order, one.alias("q")))).alias("x"))
    people = F.array(F.struct(F.lit(name).alias("name"), F.lit("").alias("position"), F.transform("x", lambda v: v["q"]).alias("quotes")))
    summary = F.struct(F.lit(1).alias("total_people"), F.size("x").alias("total_quotes"))
    return grouped.select(*key, F.lit("found").alias("message"), F.lit("success").alias("status"), F.struct(people.alias("people"), summary.alias("summary")).alias("data"))


ANSWER = "struct<data:struct<people:array<struct<name:string,quotes:array<struct<text:string>>>>>>"


def valid_answers(answers: DataFrame, answer: str, source: str) -> DataFrame:
    """Adds valid: the answer is JSON, and each of its names and quotations that isn't empty occurs in the source."""
    parsed = F.from_json(X.json_object(F.col(answer)), ANSWER)
    people = parsed["data"]["people"]
    inside = lambda s: (F.coalesce(s, F.lit("")) == "") | F.contains(F.col(source), s)
    good = F.forall(people, lambda p: inside(p["name"]) & F.coalesce(F.forall(p["quotes"], lambda q: inside(q["text"])), F.lit(True)))
    return answers.withColumn("valid", F.coalesce(good, F.lit(False)))


PROOF = "struct<`错误列表`:array<struct<`原始值`:string,`建议修改值`:string>>>"


def valid_corrections(answers: DataFrame, answer: str, source: str) -> DataFrame:
    """Adds valid: the list of corrections is not empty, each original occurs in the source without tags and blanks, and differs."""
    items = F.from_json(X.json_object(F.col(answer)), PROOF)["错误列表"]
    clean = F.regexp_replace(X.strip_tags(F.col(source)), r"\s+", "")
    good = F.forall(items, lambda e: F.contains(clean, F.regexp_replace(X.strip_tags(e["原始值"]), r"\s+", "")) & (e["原始值"] != e["建议修改值"]))
    return answers.withColumn("valid", F.coalesce((F.size(items) > 0) & good, F.lit(False)))


#: What a client is told after an answer that doesn't hold.
REPAIR = "Your last answer was not valid. Answer with one strict JSON object only."


def answer_of(prompt: str, client: Callable[..., str], valid: Callable[[str, str], bool] | None, attempts: int, repair: str | None) -> tuple[str | None, str | None, int, list[str]]:
    """(answer, error, attempts, answers that didn't hold). A client that takes one is given the history for a repair."""
    answer, error, bad, n = None, None, [], 0
    for n in range(1, attempts + 1):
        try:
            answer = client(prompt) if not (bad and repair) else client(f"{prompt}\n\n{bad[-1]}\n\n{repair}")
            error = None if valid is None or valid(answer, prompt) else "the answer doesn't hold"
        except Exception as e:  # noqa: BLE001
            answer, error = None, f"{type(e).__name__}: {e}"
        if error is None:
            break
        if answer is not None:
            bad.append(answer)
    return answer, error, n, bad


def ask(records: DataFrame, key: str, prompt: str, client: Callable[[str], str], attempts: int = 3, valid: Callable[[str, str], bool] | None = None, repair: str | None = None) -> DataFrame:
    """Answers of an injected client: key, answer, error, attempts, rejected (earlier answers that didn't hold).

    ``valid`` tells whether an answer holds for its prompt: an answer that doesn't is asked for again, with ``repair`` (if
    given) and the bad answer behind the prompt, up to ``attempts`` times; the last one stays with an error. A failure is a row
    with its error, never an exception.
    """
    source = records.select(F.col(key).alias("k"), F.col(prompt).alias("p"))

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            rows = [(k, *answer_of(p, client, valid, attempts, repair)) for k, p in zip(pdf.k, pdf.p)]
            yield pd.DataFrame(rows, columns=["k", "answer", "error", "attempts", "rejected"])

    return source.mapInPandas(run, f"k {records.schema[key].dataType.simpleString()}, answer string, error string, attempts int, rejected array<string>").withColumnRenamed("k", key)


def is_json(answer: str, prompt: str) -> bool:
    """Whether an answer holds a JSON object."""
    a, b = answer.find("{"), answer.rfind("}")
    try:
        return 0 <= a < b and isinstance(json.loads(answer[a : b + 1]), dict)
    except ValueError:
        return False


def names_occur(answer: str, source: str) -> bool:
    """Whether an answer is JSON and each of its names and quotations that isn't empty occurs in the source."""
    a, b = answer.find("{"), answer.rfind("}")
    try:
        people = json.loads(answer[a : b + 1])["data"]["people"]
        said = [t or "" for p in people for t in (p.get("name"), *(q.get("text") for q in p.get("quotes") or []))]
    except (ValueError, KeyError, TypeError, AttributeError):
        return False
    return all(t in source for t in said)


def adjudicate(records: DataFrame, key: str, text: str, found: DataFrame, client: Callable[[str], str], instruction: str, attempts: int = 2) -> DataFrame:
    """Verdicts of a client on the candidates of each record: key, id, keep, text, type, for ``adjudicated``.

    The prompt holds the instruction, the record's text and its candidates as JSON; an answer that isn't a JSON object is
    asked for once more with a request for repair.
    """
    listed = found.groupBy(key).agg(F.to_json(F.array_sort(F.collect_list(F.struct("start", "id", F.col("text").alias("quote_text"), "cue", "speaker", "context", "source")))).alias("__list"))
    prompts = records.join(listed, key).select(key, F.concat_ws("\n\n", F.lit(instruction), F.col(text), F.col("__list")).alias("__prompt"))
    answers = ask(prompts, key, "__prompt", client, attempts, is_json, REPAIR)
    items = F.from_json(X.json_object(F.col("answer")), "items array<struct<id:string,keep:boolean,type:string,text:string>>")["items"]
    return answers.filter("error is null").select(key, F.explode(items).alias("i")).select(key, "i.id", F.coalesce("i.keep", F.lit(False)).alias("keep"), X.strip_references(F.col("i.text")).alias("text"), F.coalesce("i.type", F.lit("direct")).alias("type"))


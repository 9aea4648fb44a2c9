"""Personal data: patterns, and terms that give protected entities away.

Emails, IP addresses, card and phone numbers are found by pattern; they are the
protected entities. The corpus then tells how strongly a term reveals one: with
the numbers of different texts that hold the term near the entity (n_te), the
term (n_t), the entity (n_e), of N texts in all, the disclosure is

    PMI(t; e) / IC(e) = ln(N n_te / (n_t n_e)) / ln(N / n_e)

that is, the part of the entity's information that the term carries; 1 if the
term never occurs without the entity. In texts that hold the entity, terms from
``GENERALISE_AT`` on are generalised (cut to their first letters), from
``REMOVE_AT`` on removed. Exact copies of a text count once.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskwin.llm.batches import small_batches
from riskwin.llm.columns import columns
from riskwin.session import checkpoint_root

KINDS = ("email", "ip", "card", "phone")
TERM = "term"
#: Words before and after an entity that count as near it.
NEAR_WORDS = 20
#: Different texts that hold a term near an entity, at least, where a caller
#: does not say; the query counts every entity and pair, from one text on.
MIN_TEXTS = 3
GENERALISE_AT, REMOVE_AT = 0.8, 0.95
#: Candidate terms up to this number are broadcast to be counted (each is a
#: word, so about 10 MB); more are counted by a join.
BROADCAST_TERMS = 200_000
#: Hashes of texts with such terms up to this number (1.6 MB) are broadcast to
#: find the texts; more are joined.
BROADCAST_TEXTS = 100_000

_LOCAL = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# a match always begins at the first digit of a run, so only these are tried
_IP = re.compile(r"(?<![0-9])[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")
_TERM = re.compile(r"[^\W\d_]{3,}")

FOUND = ("hash long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, base string, "
         "near array<struct<entity:string,terms:array<string>>>")


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        x = int(d) * (1 + i % 2)
        total += x - 9 if x > 9 else x
    return total % 10 == 0


def emails(text: str) -> list[tuple[int, int]]:
    """Leftmost matches of the address pattern, in one pass over the at-signs."""
    out, reach, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > reach and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            out.append((start, domain.end()))
            reach = domain.end()
        else:
            reach = max(reach, at + 1)
        at = text.find("@", max(at + 1, reach))
    return out


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) by kind as in ``KINDS``, then by place."""
    out = [("email", a, b) for a, b in emails(text)]
    if _DIGIT.search(text) is None:
        return out
    out += [("ip", *m.span()) for m in _IP.finditer(text) if all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in m[0].split("."))]
    for m in _CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if 16 <= len(digits) <= 19 and luhn(digits):
            out.append(("card", *m.span()))
    if "+" in text:
        out += [("phone", *m.span()) for m in _PHONE.finditer(text) if 8 <= sum(map(str.isdigit, m[0])) <= 15]
    return out


def entity(kind: str, value: str) -> str:
    """Protected entity behind a span's text."""
    return f"{kind}:{value.lower() if kind == 'email' else value if kind == 'ip' else re.sub('[^0-9]', '', value)}"


def joined(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def parsed(spans: str) -> list[tuple[str, int, int]]:
    return [(k, int(a), int(b)) for k, a, b in (s.split(":") for s in spans.split(",") if s)]


def terms_in(text: str) -> list[tuple[str, int, int]]:
    """Lower-cased words of three letters or more, and where they are."""
    return [(m[0].lower(), *m.span()) for m in _TERM.finditer(text)]


def near_terms(text: str, spans: list[tuple[str, int, int]], words: int = NEAR_WORDS) -> list[dict]:
    """Terms near each entity, outside all spans: so many whole words on each
    side, however far they are."""
    out: dict[str, set[str]] = {}
    outside = _outside(text, spans)
    starts, ends = [s for _, s, _ in outside], [e for _, _, e in outside]
    for kind, a, b in spans:
        before, after = bisect_right(ends, a), bisect_left(starts, b)
        near = outside[max(0, before - words):before] + outside[after:after + words]
        out.setdefault(entity(kind, text[a:b]), set()).update(t for t, _, _ in near)
    return [{"entity": e, "terms": sorted(t)} for e, t in sorted(out.items())]


def _outside(text: str, spans: list[tuple[str, int, int]]) -> list[tuple[str, int, int]]:
    """``terms_in`` without the terms that begin inside a span."""
    out, reach, k, order = [], 0, 0, sorted((a, b) for _, a, b in spans)
    for term in terms_in(text):
        while k < len(order) and order[k][0] <= term[1]:
            reach = max(reach, order[k][1])
            k += 1
        if term[1] >= reach:
            out.append(term)
    return out


def _inside(place: int, spans: list[tuple[str, int, int]]) -> bool:
    return any(a <= place < b for _, a, b in spans)


def _hash(text: Column) -> Column:
    return F.xxhash64(F.coalesce(text.cast("string"), F.lit("")))


def detect(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The pattern matches of every row: ``doc_id`` and the columns of ``FOUND``."""
    small_batches(docs.sparkSession)
    names = [x.split()[0] for x in FOUND.split(", ")]
    near = pa.list_(pa.struct([("entity", pa.string()), ("terms", pa.list_(pa.string()))]))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for text in b.column(2).to_pylist():
                spans = base_spans(text or "")
                kinds = [s[0] for s in spans]
                base = joined(spans)
                rows.append((*(kinds.count(k) for k in KINDS), hashlib.sha256(base.encode()).hexdigest(), base,
                             near_terms(text, spans) if spans else []))
            columns = list(zip(*rows)) if rows else [()] * 7
            kinds = [pa.int64()] * 4 + [pa.string()] * 2 + [near]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), *(pa.array(c, k) for c, k in zip(columns, kinds))], ["doc_id", *names])

    text = F.col(f"`{text_col}`")
    rows = docs.select(F.col(f"`{id_col}`").alias("doc_id"), _hash(text).alias("hash"), text.cast("string").alias("text"))
    return rows.mapInArrow(task, f"doc_id {dict(rows.dtypes)['doc_id']}, {FOUND}")


def disclosures(found: DataFrame, texts: DataFrame, min_texts: int = MIN_TEXTS, at_least: float = GENERALISE_AT,
                broadcast_terms: int = BROADCAST_TERMS) -> DataFrame:
    """(entity, term, disclosure) from ``detect``'s rows and all texts (hash, text)."""
    n_texts = found.select("hash").distinct().count()
    held = found.filter(F.size("near") > 0).select("hash", "near").dropDuplicates(["hash"]).select(
        "hash", F.explode("near").alias("near")).select("hash", "near.*")
    n_e = held.groupBy("entity").agg(F.count("*").alias("n_e")).filter(F.col("n_e") >= min_texts)
    near = held.select("hash", "entity", F.explode("terms").alias("term"))
    n_te = near.groupBy("entity", "term").agg(F.count("*").alias("n_te")).filter(F.col("n_te") >= min_texts)
    # a term is in no fewer texts than hold it near some entity, which bounds
    # its disclosure from above: only pairs that can reach the threshold are counted
    least_n_t = near.select("hash", "term").distinct().groupBy("term").agg(F.count("*").alias("n_t"))
    information = F.log(F.lit(float(max(n_texts, 1))) / F.col("n_e"))
    share = F.when(information > 0, 1 + F.log(F.col("n_te") / F.col("n_t")) / information).otherwise(0.0)
    pairs = (
        n_te.join(n_e, "entity").join(least_n_t, "term").filter(share >= at_least).drop("n_t").checkpoint()
    )
    n_t = count_terms(texts, pairs.select("term").distinct(), broadcast_terms)
    return pairs.join(n_t, "term").select("entity", "term", share.alias("disclosure")).filter(F.col("disclosure") >= at_least)


def count_terms(texts: DataFrame, terms: DataFrame, broadcast_terms: int = BROADCAST_TERMS) -> DataFrame:
    """(term, n_t): different texts that hold each of the terms."""
    few = terms.limit(broadcast_terms + 1).count() <= broadcast_terms
    wanted = texts.sparkSession.sparkContext.broadcast(frozenset(r["term"] for r in terms.collect())) if few else None
    if few and not wanted.value:
        return terms.select("term", F.lit(0).cast("long").alias("n_t"))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            hashes, own = [], []
            for h, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                found = set(_TERM.findall((text or "").lower()))
                if wanted is not None:
                    found &= wanted.value
                if found:
                    hashes.append(h)
                    own.append(sorted(found))
            yield pa.RecordBatch.from_arrays([pa.array(hashes, pa.int64()), pa.array(own, pa.list_(pa.string()))], ["hash", "terms"])

    held = texts.mapInArrow(task, "hash long, terms array<string>").dropDuplicates(["hash"])
    held = held.select(F.explode("terms").alias("term"))
    if not few:
        held = held.join(terms, "term", "left_semi")
    return held.groupBy("term").agg(F.count("*").alias("n_t"))


def personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_texts: int = MIN_TEXTS,
                  generalise_at: float = GENERALISE_AT, remove_at: float = REMOVE_AT) -> DataFrame:
    """For every row: ``doc_id``, ``hash`` (of the text), counts by kind,
    ``base_sha256``, ``spans`` (all, as kind:start:end in code points) and
    ``removed`` (those terms that are removed rather than generalised).

    A null text counts as empty and has no span. Repeated rows come back
    repeated; an empty table gives no rows.
    """
    checkpoint_root(docs.sparkSession)
    text = F.col(f"`{text_col}`")
    texts = docs.select(_hash(text).alias("hash"), F.coalesce(text.cast("string"), F.lit("")).alias("text"))
    found = detect(docs, id_col, text_col).checkpoint()
    shown = disclosures(found, texts, min_texts, generalise_at)
    entities = found.filter(F.size("near") > 0).select("hash", "base", F.explode("near.entity").alias("entity")).distinct()
    of_text = (
        entities.join(shown, "entity").groupBy("hash", "base", "term").agg(F.max("disclosure").alias("disclosure"))
        .groupBy("hash", "base").agg(F.map_from_entries(F.collect_list(F.struct("term", "disclosure"))).alias("terms"))
    )

    @F.pandas_udf("terms string, removed string")
    def term_spans(own: pd.Series, bases: pd.Series, terms: pd.Series) -> pd.DataFrame:
        rows = []
        for t, base, d in zip(own, bases, terms):
            d, spans = dict(d), parsed(base)
            hits = [(w, a, b) for w, a, b in terms_in(t) if w in d and not _inside(a, spans) and not _inside(b - 1, spans)]
            rows.append((joined([(TERM, a, b) for w, a, b in hits]),
                         joined([(TERM, a, b) for w, a, b in hits if d[w] >= remove_at])))
        return pd.DataFrame(rows, columns=["terms", "removed"])

    of_text = of_text.checkpoint()
    few = of_text.limit(BROADCAST_TEXTS + 1).count() <= BROADCAST_TEXTS
    keys = of_text.select("hash")
    hit = texts.join(F.broadcast(keys) if few else keys, "hash", "left_semi")
    extra = hit.dropDuplicates(["hash"]).join(of_text, "hash").select(
        "hash", term_spans("text", "base", "terms").alias("t")).select("hash", "t.*")
    spans = F.concat_ws(",", F.nullif(F.col("base"), F.lit("")), F.nullif(F.col("terms"), F.lit("")))
    return found.drop("near").join(extra, "hash", "left").select(
        "doc_id", "hash", *[f"n_{k}" for k in KINDS], "base_sha256", spans.alias("spans"),
        F.coalesce("removed", F.lit("")).alias("removed"))


def sanitise_text(text: str, spans: str, removed: str) -> str:
    """Text with entities as <KIND>, terms cut to three letters and a star, and
    removed terms gone. Where spans overlap, the one that starts first (then the
    longer) holds."""
    gone = set(parsed(removed))
    out, at = [], 0
    for kind, a, b in sorted(parsed(spans), key=lambda s: (s[1], -s[2])):
        if a < at:
            continue
        out.append(text[at:a])
        if kind != TERM:
            out.append(f"<{kind.upper()}>")
        elif (kind, a, b) not in gone:
            out.append(text[a:a + 3] + "*")
        at = b
    return "".join([*out, text[at:]])


def sanitised(docs: DataFrame, found: DataFrame, text_col: str = "text", out: str = "sanitised") -> DataFrame:
    """``docs`` with the sanitised text; ``found`` is ``personal_data``'s."""
    @F.pandas_udf("string")
    def clean(texts: pd.Series, spans: pd.Series, removed: pd.Series) -> pd.Series:
        return pd.Series([sanitise_text(t or "", s, r) for t, s, r in zip(texts, spans, removed)], dtype=object)

    own = found.select("hash", "spans", "removed").dropDuplicates(["hash"])
    text = F.col(f"`{text_col}`")
    rows = docs.select(F.struct(*columns(docs, (out,))).alias("row"), text.cast("string").alias("text"), _hash(text).alias("hash"))
    return rows.join(own, "hash").select("row", clean("text", "spans", "removed").alias(out)).select(
        *[F.col("row").getField(c).alias(c) for c in docs.columns if c.lower() != out.lower()], out)


def op6_pii(spark, sf_dir: str) -> DataFrame:
    """Personal data in every document, with the terms that give it away. Most
    entities are in a single text, so none is left out for being rare."""
    return personal_data(spark.read.parquet(f"{sf_dir}/documents.parquet"), min_texts=1).select(
        "doc_id", *[f"n_{k}" for k in KINDS], "base_sha256", "spans")

"""Personal data: patterns, and terms that reveal what the patterns protect.

Patterns find emails, ip addresses, card and phone numbers (``base_spans``). Every different
value found is an entity to be protected. Information-theoretic sanitisation then looks for
terms that give an entity away although no pattern knows them, as a name that always stands
beside one address. With probabilities as shares of the corpus's documents,

    information of an entity  IC(e)     = -log2 p(e)
    what a term tells of it   PMI(t, e) = log2(p(t, e) / (p(t) p(e)))

where p(t, e) counts documents with t among the ``near`` words before or behind a mention of e,
and p(t) all documents with t. A term is disclosing if it leaves at most ``bits_left`` of IC(e)
and tells at least ``share`` of it, seen in at least ``contexts`` different surroundings; copies
of a passage are one surrounding, so a single text and its copies reveal nothing. A disclosing
term with digits is generalised to its form with ``#`` for every digit if that form, counted as a
term itself, does not disclose the entity; other ones are removed.

Terms are words ``[^\\x20\\x09-\\x0D]+`` without punctuation at their ends, A-Z lower-cased, that
touch no span of a pattern. Defined results: null and empty texts have no spans. Rows are
counted as they are there: repeated rows and rows without id are documents of their own. Ties
cannot arise. An empty table gives no rows. Other columns are kept, whatever their names. Very
long texts are searched whole in time that grows with their length; a task holds one batch.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arrivals_engine.llm.common import Scratch, free_name

Span = tuple[int, int, str]

# The kinds, in the order in which spans that begin together are listed, and their
# patterns. Each is written so that a failing search takes no more than linear time: an email
# is found from its domain, and numbers are tried at their first digit only.
KINDS = ("email", "ip", "card", "phone")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

TERM = "term"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
EDGES = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
_FORM = str.maketrans("0123456789", "#" * 10)
_EDGES, _FORMS = EDGES.encode(), bytes.maketrans(b"0123456789", b"#" * 10)

#: So many different terms, or mentions, of a task are gathered before they are handed on.
COUNTED = 200_000
#: So many terms go to every task.
MOST_BROADCAST = 1_000_000
MENTION = ["entity", "term", "context", "first"]


# ---- patterns -------------------------------------------------------------


def _emails(text: str) -> Iterator[tuple[int, int]]:
    last = 0
    for m in DOMAIN.finditer(text):
        start = m.start()
        while start > last and text[start - 1] in LOCAL:
            start -= 1
        if start < m.start():
            last = m.end()
            yield start, last


def _is_ip(found: str) -> bool:
    parts = [part.lstrip("0") for part in found.split(".")]
    return all(len(part) <= 3 and int(part or 0) <= 255 for part in parts)


def _is_card(found: str) -> bool:
    digits = [int(c) for c in found if c not in " -"] if len(found) <= 40 else []
    if not 14 <= len(digits) <= 19:
        return False
    twice = [2 * d - 9 * (d > 4) for d in digits[-2::-2]]
    return (sum(digits[-1::-2]) + sum(twice)) % 10 == 0


def _is_phone(found: str) -> bool:
    return 10 <= sum(c in "0123456789" for c in found) <= 15


def base_spans(text: str | None) -> list[Span]:
    """(start, end, kind) of all patterns by start, then kind, in code points."""
    text = text or ""
    found = [(*span, "email") for span in _emails(text)] if "@" in text else []
    for kind, pattern, holds in (("ip", IP, _is_ip), ("card", CARD, _is_card), ("phone", PHONE, _is_phone)):
        found += [(m.start(), m.end(), kind) for m in pattern.finditer(text) if holds(m.group())]
    return sorted(found, key=lambda s: (s[0], KINDS.index(s[2])))


def entity(text: str, span: Span) -> str:
    """A mention's value, written in one way: numbers as their digits, emails in small letters."""
    value = text[span[0] : span[1]]
    if span[2] in ("card", "phone"):
        value = re.sub(r"[^0-9]", "", value)
    return f"{span[2]}:{value.translate(_LOWER)}"


# ---- terms ----------------------------------------------------------------


def terms(text: str, spans: list[Span]) -> list[Span]:
    """(start, end, term) of all terms that touch no span."""
    found = []
    starts, reach, far = [s[0] for s in spans], [], 0
    for s in spans:
        far = max(far, s[1])
        reach.append(far)
    for m in WORD.finditer(text):
        word = m.group()
        bare = word.strip(EDGES)
        if not bare:
            continue
        k = bisect_right(starts, m.end() - 1)
        if k and reach[k - 1] > m.start():
            continue
        start = m.start() + len(word) - len(word.lstrip(EDGES))
        found.append((start, start + len(bare), bare.translate(_LOWER)))
    return found


def form(term: str) -> str | None:
    """The term with # for every digit, or None if it has none."""
    masked = term.translate(_FORM)
    return masked if masked != term else None


def _words(text: str) -> set[bytes]:
    """The different words of a text as terms are written, those that touch a span among them, in
    less time: lower() of bytes is that of A-Z, and split() is at WORD's gaps."""
    return {w.strip(_EDGES) for w in set(text.encode().lower().split())}


def _all_terms(text: str, words: set[bytes]) -> set[str]:
    """The different terms of a text, and their forms. words: those of the text."""
    spans = base_spans(text)
    if spans:
        found = {t for _, _, t in terms(text, spans)}
    else:
        found = {w.decode() for w in words if w}
    return found | {f for f in map(form, found) if f}


def _counted(wanted: frozenset[str] | None):
    def of(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """(term, n): in n texts of a batch or several there is the term, of all or wanted ones."""
        counts: Counter[str] = Counter()
        asked = None if wanted is None else {t.encode() for t in wanted}
        for batch in batches:
            for text in batch["text"]:
                words = _words(text or "")
                if asked is None:
                    counts.update(_all_terms(text or "", words))
                elif not asked.isdisjoint(words) or not asked.isdisjoint({w.translate(_FORMS) for w in words}):
                    counts.update(_all_terms(text, words) & wanted)
                if len(counts) > COUNTED:
                    yield pd.DataFrame(counts.items(), columns=["term", "n"])
                    counts.clear()
        yield pd.DataFrame(counts.items(), columns=["term", "n"])

    return of


def _mentions(near: int):
    def of(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """(entity, term, context, first): the terms near each mention, and for each entity an
        empty term. first is 1 in one row per text, entity and term."""
        for batch in batches:
            rows = []
            for text in batch["text"]:
                spans = base_spans(text)
                if not spans:
                    continue
                words, seen = terms(text, spans), set()
                starts = [w[0] for w in words]
                for span in spans:
                    who, at = entity(text, span), bisect_right(starts, span[0])
                    around = [w[2] for w in words[max(0, at - near) : at + near]]
                    context = hashlib.md5(" ".join(around).encode()).digest()[:8]
                    number = int.from_bytes(context, "big", signed=True)
                    told = dict.fromkeys(["", *around, *filter(None, map(form, around))])
                    for term in told:
                        rows.append((who, term, number, int((who, term) not in seen)))
                        seen.add((who, term))
                    if len(rows) > COUNTED:
                        yield pd.DataFrame(rows, columns=MENTION)
                        rows = []
            yield pd.DataFrame(rows, columns=MENTION)

    return of


@dataclass(frozen=True)
class Limits:
    """When a term discloses an entity, see above. ``near`` is so many words to each side."""

    near: int = 8
    contexts: int = 3
    bits_left: float = 0.5
    share: float = 0.5


def associations(
    docs: DataFrame, limits: Limits = Limits(), most_broadcast: int = MOST_BROADCAST
) -> DataFrame:
    """(entity, term, together, contexts, n_entity, n_term, n_docs, ic, pmi, disclosing) of all
    terms and forms that stand near an entity in enough different surroundings. If these are
    no more than ``most_broadcast``, texts are searched for them alone, else all terms are counted."""
    texts = docs.select("text")
    seen = texts.mapInPandas(_mentions(limits.near), "entity string, term string, context long, first int")
    apart = seen.groupBy("entity", "term", "context").agg(F.sum("first").alias("together"))
    near = apart.groupBy("entity", "term").agg(
        F.sum("together").alias("together"), F.count(F.lit(1)).alias("contexts")
    )
    near = Scratch(docs.sparkSession, "pii").put(
        near.where((F.col("contexts") >= limits.contexts) | (F.col("term") == "")), "near"
    )
    entities = near.where("term = ''").select("entity", F.col("together").alias("n_entity"))
    told = near.where((F.col("term") != "") & (F.col("contexts") >= limits.contexts))
    asked = told.select("term").distinct()
    few = asked.count() <= most_broadcast
    wanted = frozenset(r["term"] for r in asked.toLocalIterator()) if few else None
    counted = texts.mapInPandas(_counted(wanted), "term string, n long")
    if not few:
        counted = counted.join(asked, "term", "left_semi")
    in_all = counted.groupBy("term").agg(F.sum("n").alias("n_term"))
    joined = told.join(entities, "entity").join(in_all, "term")
    joined = joined.withColumn("n_docs", F.lit(docs.count()).cast("long"))
    ic = -F.log2(F.col("n_entity") / F.col("n_docs"))
    pmi = F.log2(F.col("together") * F.col("n_docs") / (F.col("n_term") * F.col("n_entity")))
    return joined.withColumns({"ic": ic, "pmi": pmi}).withColumn(
        "disclosing",
        (F.col("ic") - F.col("pmi") <= limits.bits_left)
        & (F.col("pmi") >= limits.share * F.col("ic"))
        & (F.col("pmi") > 0),
    )


def disclosing_terms(
    docs: DataFrame, limits: Limits = Limits(), most_broadcast: int = MOST_BROADCAST
) -> DataFrame:
    """(term, written): what is written in place of each disclosing term, its form or nothing."""
    found = associations(docs, limits, most_broadcast).where("disclosing").select("entity", "term")
    found = Scratch(docs.sparkSession, "pii").put(found, "disclosing")
    masked = F.translate("term", "0123456789", "#" * 10)
    forms = found.select("entity", F.col("term").alias("form"), F.lit(True).alias("told"))
    per_entity = (
        found.withColumn("form", masked)
        .where(F.col("form") != F.col("term"))
        .join(forms, ["entity", "form"], "left")
        .select("entity", "term", F.coalesce("told", F.lit(False)).alias("told"))
    )
    kept = found.join(per_entity, ["entity", "term"], "left").groupBy("term").agg(
        F.bool_or(F.coalesce("told", F.lit(True))).alias("told")
    )
    # A form is there to be counted; only a word that is its own form is a term of a text.
    return kept.select(
        "term",
        F.when(~F.col("told"), masked.alias("written")).otherwise(F.lit("")).alias("written"),
    )


# ---- spans and clean texts ------------------------------------------------


FOUND = "spans array<struct<start:long,end:long,kind:string>>, clean string"


def _marked(known: dict[str, str] | None):
    def mark(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        asked = {t.encode() for t in known or ()}
        for texts, written in batches:
            out = []
            for text, own in zip(texts, written, strict=True):
                spans = base_spans(text)
                say = dict(own) if own is not None else {}
                if known and text and not asked.isdisjoint(_words(text)):
                    say = known
                told = [t for t in terms(text, spans) if t[2] in say] if text and say else []
                every = sorted(
                    [*spans, *((s, e, TERM) for s, e, _ in told)],
                    key=lambda s: (s[0], (*KINDS, TERM).index(s[2])),
                )
                puts = [(s, e, f"[{kind.upper()}]") for s, e, kind in spans]
                puts += [(s, e, say[t]) for s, e, t in told]
                out.append(([{"start": s, "end": e, "kind": k} for s, e, k in every], replaced(text, puts)))
            yield pd.DataFrame(out, columns=["spans", "clean"])

    return mark


def replaced(text: str | None, puts: list[tuple[int, int, str]]) -> str | None:
    """The text with something else in place of each span; spans that overlap are one, and the
    first of them says what is put there."""
    if not puts:
        return text
    parts, at = [], 0
    for start, end, put in sorted(puts, key=lambda p: (p[0], -p[1])):
        if start >= at:
            parts += [text[at:start], put]
        at = max(at, end)
    return "".join([*parts, text[at:]])


def sanitised(
    docs: DataFrame,
    limits: Limits = Limits(),
    *,
    into: str = "found",
    most_broadcast: int = MOST_BROADCAST,
) -> DataFrame:
    """docs and a struct column ``into``: ``spans`` (start, end, kind) and the ``clean`` text, in
    which patterns are named by their kind and terms are generalised or gone. Up to
    ``most_broadcast`` disclosing terms go to every task; beyond that each text is joined with
    the disclosing ones of its own terms."""
    if into in docs.columns:
        raise ValueError(f"docs has a column {into!r} already")
    spark = docs.sparkSession
    say = Scratch(spark, "pii").put(disclosing_terms(docs, limits, most_broadcast), "terms")
    if say.count() <= most_broadcast:
        known = {r["term"]: r["written"] for r in say.toLocalIterator()}
        mark = F.pandas_udf(_marked(known), FOUND)
        return docs.withColumn(into, mark(F.col("text"), F.lit(None).cast("string")))
    key = free_name(docs, "_pii_key")
    # Equal texts have equal terms, so a digest of the text is enough to find them again.
    keyed = docs.withColumn(key, F.md5(F.coalesce("text", F.lit(""))))
    own = (
        keyed.select(key, "text")
        .where(F.col("text").isNotNull())
        .mapInPandas(_own_terms(key), f"{key} string, term string")
        .distinct()
        .join(say, "term")
        .groupBy(key)
        .agg(F.map_from_entries(F.collect_list(F.struct("term", "written"))).alias(into))
    )
    mark = F.pandas_udf(_marked(None), FOUND)
    return keyed.join(own, key, "left").withColumn(into, mark(F.col("text"), F.col(into))).drop(key)


def _own_terms(key: str):
    def of(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for k, text in zip(batch[key], batch["text"], strict=True):
                rows += [(k, t) for t in {t for _, _, t in terms(text, base_spans(text))}]
                if len(rows) > COUNTED:
                    yield pd.DataFrame(rows, columns=[key, "term"])
                    rows = []
            yield pd.DataFrame(rows, columns=[key, "term"])

    return of


def span_digests(docs: DataFrame, limits: Limits = Limits(), **how) -> DataFrame:
    """Per row of docs how many spans of each pattern it has, their digest, and all spans."""
    rows = sanitised(docs.select("doc_id", "text"), limits, **how)
    spans = F.col("found.spans")
    base = F.filter(spans, lambda s: s["kind"] != TERM)

    def number(kind):
        return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    def listed(found):
        return F.array_join(F.transform(found, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    return rows.select(
        "doc_id", *map(number, KINDS), F.sha2(listed(base), 256).alias("base_sha256"), listed(spans).alias("spans")
    )

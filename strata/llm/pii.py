"""Personal data (operator 7): information-theoretic sanitisation.

Protected entities are the mail addresses, network addresses, card and phone numbers that fixed
patterns find. Corpus co-occurrence then estimates how strongly other terms reveal them: for an
entity c and a term t in the same document, the pointwise mutual information ln(p(c,t) / (p(c) p(t))), taken
as a share of the entity's own information -ln p(c). A share of 1 means that the term gives the
entity away. In documents that mention c, terms whose share reaches `generalise_at` are replaced
by their shape, and those that reach `remove_at` are removed.

All statistics run over all documents: a term's document frequency is counted in the whole
corpus, and a term meets every entity of its document, or, if `window` is given, those with a
mention within so many words. Entities of fewer documents than `support` can reveal nothing, so
only the others' documents are paired with their terms.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import arrow_schema, stored, table_batch

#: The kinds in the order that breaks ties, and their patterns.
KINDS = ("email", "ip", "card", "phone", "term")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL_END = re.compile(r"[^A-Za-z0-9._%+-]")
_IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_NOT_DIGIT = re.compile(r"[^0-9]")
_TERM = re.compile(r"\w+")

#: Bits of the filter that spares counting terms no entity is near: 16 to 32 for each candidate, from the
#: fewest to the most; each sets PROBES of them, so of the others one in 400 passes. Beyond the most
#: bits more pass; a join drops them and none is lost.
FEWEST_SLOTS, MOST_SLOTS, PROBES = 1 << 18, 1 << 24, 4
HELD = 100_000      # sums a task holds before it sends them on


@dataclass(frozen=True)
class Disclosure:
    """window: words either side of a mention, or None for the whole document; support: documents
    that must hold term and entity together. Two is the least that is evidence: of what one document
    alone holds, every term has share 1 for every entity. Shares of information from which a
    term is generalised or removed."""

    window: int | None = None
    support: int = 2
    generalise_at: float = 0.8
    remove_at: float = 0.95


def luhn(digits: str) -> bool:
    total = 0
    for i, ch in enumerate(reversed(digits)):
        n = ord(ch) - 48
        if i % 2:
            n = n * 2 - 9 if n > 4 else n * 2
        total += n
    return total % 10 == 0


def _emails(text: str):
    """Each `@` is tried once: the local part before it, back to the last match at most, then the
    domain. Equal to a leftmost regular expression search, without its retries."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and not _LOCAL_END.match(text, start - 1):
            start -= 1
        m = _DOMAIN.match(text, at + 1) if start < at else None
        if m:
            yield start, m.end()
            done = m.end()
        at = text.find("@", max(at + 1, done))


def _small(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) < 4 and (part == "" or int(part) <= 255)


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind number, end) of the fixed patterns, in order; places are code points."""
    out = [(a, 0, b) for a, b in _emails(text)]
    for m in _IP.finditer(text):
        if all(map(_small, m[0].split("."))):
            out.append((m.start(), 1, m.end()))
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 14:
            digits = _NOT_DIGIT.sub("", m[0])
            if 14 <= len(digits) <= 19 and luhn(digits):
                out.append((m.start(), 2, m.end()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 10 <= len(_NOT_DIGIT.sub("", m[0])) <= 15:
                out.append((m.start(), 3, m.end()))
    return sorted(out)


def listed(spans) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)


def _terms(text: str, spans) -> list[tuple[int, int, str]]:
    """(start, end, lower-cased term) of words and numbers outside the base spans."""
    out, i = [], 0
    spans = sorted((a, b) for a, _, b in spans)
    for m in _TERM.finditer(text):
        while i < len(spans) and spans[i][1] <= m.start():
            i += 1
        if i < len(spans) and m.end() > spans[i][0]:
            continue
        out.append((m.start(), m.end(), m[0].lower()))
    return out


def _entity(text: str, a: int, k: int, b: int) -> str:
    value = text[a:b]
    return f"{KINDS[k]}:{_NOT_DIGIT.sub('', value) if k >= 2 else value.lower()}"


def near_entities(text: str, spans, window: int | None, wanted=lambda entity: True) -> dict[str, set[str]]:
    """`wanted` entity -> terms within `window` words of one of its mentions (None: all terms)."""
    named = [(a, e) for a, k, b in spans if wanted(e := _entity(text, a, k, b))]
    if not named:
        return {}
    terms = _terms(text, spans)
    if window is None:
        return dict.fromkeys([e for _, e in named], {t[2] for t in terms})
    starts = np.array([t[0] for t in terms])
    out: dict[str, set[str]] = {}
    for a, e in named:
        i = int(np.searchsorted(starts, a))
        out.setdefault(e, set()).update(t[2] for t in terms[max(0, i - window):i + window])
    return out


_FOUND = [T.StructField("counts", T.ArrayType(T.LongType())), T.StructField("base", T.StringType()),
          T.StructField("entities", T.ArrayType(T.StringType()))]


def _scan(all_texts: bool, schema: T.StructType):
    out = arrow_schema(schema)

    def run(batches):
        for batch in batches:
            texts = batch.column("text").to_pylist()
            spans = [base_spans(x) for x in texts]
            cols = {n: batch.column(n) for n in batch.schema.names}
            cols["text"] = [x if s or all_texts else None for x, s in zip(texts, spans)]
            cols["counts"] = [[sum(1 for x in s if x[1] == k) for k in range(4)] for s in spans]
            cols["base"] = [listed(s) for s in spans]
            cols["entities"] = [sorted({_entity(x, *span) for span in s}) for x, s in zip(texts, spans)]
            yield table_batch(cols, out)
    return run


def _slots(df: DataFrame, column: str) -> bytes:
    """A bitmap of at most MOST_SLOTS bits; false positives only add rows that a join drops."""
    size = 1 << (min(max(16 * df.select(column).distinct().count(), FEWEST_SLOTS), MOST_SLOTS) - 1).bit_length()
    h = F.xxhash64(column)
    low, high = F.pmod(h, F.lit(size)), F.pmod(F.shiftrightunsigned(h, 32), F.lit(size))
    probes = F.array(*[F.pmod(low + i * high, F.lit(size)).cast("int") for i in range(PROBES)])
    found = df.select(F.explode(probes).alias("s")).distinct()
    slots = np.zeros(size, dtype=np.uint8)
    for part in found.toLocalIterator():                        # at most MOST_SLOTS numbers
        slots[part["s"]] = 1
    return np.packbits(slots).tobytes()


class _Filter:
    """Whether all probes of a string are set: the probes of `_slots`, from the same hash as Spark's."""

    def __init__(self, slots: bytes):
        self.table = np.unpackbits(np.frombuffer(slots, dtype=np.uint8)).astype(bool)

    def __call__(self, text: str) -> bool:
        h = xxhash.xxh64_intdigest(text, seed=42)
        mask = len(self.table) - 1
        return all(self.table[(h + i * (h >> 32)) & mask] for i in range(PROBES))


def _meetings(slots: bytes, window: int | None):
    """(entity, term, documents of these that hold both), for entities that pass the filter."""
    def run(batches):
        wanted = _Filter(slots)
        found: Counter = Counter()

        def rows():
            pairs = list(found)
            out = pa.RecordBatch.from_pydict({"entity": pa.array([e for e, _ in pairs], pa.string()),
                                              "term": pa.array([t for _, t in pairs], pa.string()),
                                              "n": pa.array(list(found.values()), pa.int64())})
            found.clear()
            return out

        for batch in batches:
            for text in batch.column(0).to_pylist():
                near = near_entities(text, base_spans(text), window, wanted)
                for e, terms in near.items():
                    found.update((e, t) for t in terms)
                    if len(found) > HELD:
                        yield rows()
        if found:
            yield rows()
    return run


def _held_terms(batches):
    """(term, documents of this batch that hold it)."""
    for batch in batches:
        found: Counter = Counter()
        for text in batch.column(0).to_pylist():
            found.update(set(_TERM.findall(text.lower())))
        yield pa.RecordBatch.from_pydict({"term": pa.array(list(found), pa.string()),
                                          "least": pa.array(list(found.values()), pa.int64())})


def _frequencies(slots: bytes):
    """(term, documents of this task that hold it), for terms that pass the filter."""
    def run(batches):
        passes = _Filter(slots)
        wanted: dict[str, bool] = {}
        found: Counter = Counter()

        def rows():
            out = pa.RecordBatch.from_pydict({"term": pa.array(list(found), pa.string()),
                                              "n": pa.array(list(found.values()), pa.int64())})
            found.clear()
            return out

        for batch in batches:
            for text in batch.column(0).to_pylist():
                for term in set(_TERM.findall(text.lower())):
                    ok = wanted.get(term)
                    if ok is None:
                        if len(wanted) > 300_000:
                            wanted.clear()
                        ok = wanted[term] = passes(term)
                    if ok:
                        found[term] += 1
                if len(found) > HELD:
                    yield rows()
        if found:
            yield rows()
    return run


def disclosing_terms(scanned: DataFrame, texts: DataFrame, how: Disclosure) -> DataFrame:
    """(entity, term, share): terms that reach `generalise_at` of an entity's information.
    `scanned` holds `entities` and `text` per document; `texts` one column with every text."""
    total = scanned.count()
    entity = stored(scanned.select(F.explode("entities").alias("entity")).groupBy("entity").agg(F.count("*").alias("n_entity"))
                    .where((F.col("n_entity") >= how.support) & (F.col("n_entity") < total)), "pii-entities")
    together = stored(scanned.where(F.size("entities") > 0).select("text")
                      .mapInArrow(_meetings(_slots(entity, "entity"), how.window), "entity string, term string, n long")
                      .groupBy("entity", "term").agg(F.sum("n").alias("n_both"))
                      .where(F.col("n_both") >= how.support), "pii-together")
    n = F.lit(float(max(total, 1)))

    def share(n_term):
        information = F.log(n / F.col("n_entity"))
        return F.log(F.col("n_both") * n / (F.col("n_entity") * F.col(n_term))) / information

    # a term occurs at least in the documents with entities that hold it: where even that count is
    # too high for the share, the corpus need not be asked
    least = (scanned.where(F.size("entities") > 0).select("text").mapInArrow(_held_terms, "term string, least long")
             .groupBy("term").agg(F.sum("least").alias("least")))
    open_pairs = stored(together.join(entity, "entity").join(least, "term")
                        .where(share("least") >= how.generalise_at - 1e-9), "pii-open")
    term = (texts.mapInArrow(_frequencies(_slots(open_pairs, "term")), "term string, n long")
            .groupBy("term").agg(F.sum("n").alias("n_term")))
    return (open_pairs.join(term, "term").select("entity", "term", share("n_term").alias("share"))
            .where(F.col("share") >= how.generalise_at))


def shape(term: str) -> str:
    return "<number>" if term.isdigit() else "<Name>" if term[:1].isupper() else "<word>"


def sanitised(text: str, spans, removed: set[str]) -> str:
    """Base spans become their kind in brackets; terms their shape, or nothing if in `removed`."""
    out, at = [], 0
    for a, k, b in spans:
        if b <= at:
            continue
        if a >= at:
            out.append(text[at:a])
            if k < 4:
                out.append(f"[{KINDS[k].upper()}]")
            elif text[a:b].lower() not in removed:
                out.append(shape(text[a:b]))
        at = b
    return "".join([*out, text[at:]])


def _with_terms(how: Disclosure, schema: T.StructType):
    out = arrow_schema(schema)

    def run(batches):
        for batch in batches:
            found, clean = [], []
            for text, terms in zip(batch.column("text").to_pylist(), batch.column("terms").to_pylist()):
                spans = base_spans(text)
                share = {x["term"]: x["share"] for x in terms or []}
                if share:
                    spans = sorted([*spans, *((a, 4, b) for a, b, t in _terms(text, spans) if t in share)])
                found.append(listed(spans))
                text = sanitised(text, spans, {t for t, s in share.items() if s >= how.remove_at})
                while share and (uncovered := base_spans(text)):    # what removed terms stood between
                    text = sanitised(text, uncovered, set())
                clean.append(text)
            cols = {n: batch.column(n) for n in out.names[:-2] if n != "text"}
            yield table_batch({**cols, "text": clean, "spans": found}, out)
    return run


def _find(df: DataFrame, how: Disclosure, id_col: str, text_col: str, keep: list[str], all_texts: bool) -> DataFrame:
    """in_0.. (the columns `keep`), d, t, counts, base, text (sanitised), spans of every row."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    src = df.select(*[F.col(c).alias(f"in_{i}") for i, c in enumerate(keep)],
                    F.col(id_col).cast("long").alias("d"), F.xxhash64(text).alias("t"), text.alias("text"))
    schema = T.StructType([*[T.StructField(f.name, f.dataType) for f in src.schema.fields], *_FOUND])
    scanned = stored(src.mapInArrow(_scan(all_texts, schema), schema), "pii-scan")
    reveal = disclosing_terms(scanned, src.select("text"), how)
    mentions = scanned.select("d", "t", F.explode("entities").alias("entity")).distinct()
    by_doc = (mentions.join(reveal, "entity").groupBy("d", "t", "term").agg(F.max("share").alias("share"))
              .groupBy("d", "t").agg(F.collect_list(F.struct("term", "share")).alias("terms")))
    own = [*[f"in_{i}" for i in range(len(keep))], "d", "t", "counts", "base"]
    result = T.StructType([*[schema[c] for c in own], T.StructField("text", T.StringType()),
                           T.StructField("spans", T.StringType())])
    done = (scanned.where(F.size("entities") > 0).alias("s")
            .join(by_doc.alias("m"), F.col("s.d").eqNullSafe(F.col("m.d")) & (F.col("s.t") == F.col("m.t")), "left")
            .select(*[F.col(f"s.{c}") for c in own], "s.text", "m.terms")
            .mapInArrow(_with_terms(how, result), result))
    rest = scanned.where(F.size("entities") == 0).select(*own, "text", F.lit("").alias("spans"))
    return done.unionByName(rest)


def find(df: DataFrame, how: Disclosure = Disclosure(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """`id_col`, n_email, n_ip, n_card, n_phone, base_sha256 and spans of every row.

    `spans` lists kind:start:end by start, then kind; `base_sha256` digests the list of the base
    kinds. Null and empty texts have no spans; rows with equal id and text get equal results;
    an empty table gives no rows; other columns are not read."""
    found = _find(df, how, id_col, text_col, [], all_texts=False)
    return found.select(F.col("d").alias(id_col),
                        *[F.col("counts")[k].alias(f"n_{KINDS[k]}") for k in range(4)],
                        F.sha2(F.col("base"), 256).alias("base_sha256"), "spans")


def sanitise(df: DataFrame, how: Disclosure = Disclosure(), id_col: str = "doc_id",
             text_col: str = "text") -> DataFrame:
    """Every row and column of `df`, with `text_col` sanitised (a null text stays null)."""
    found = _find(df, how, id_col, text_col, df.columns, all_texts=True)
    at = df.columns.index(text_col)
    return found.select(*[
        (F.when(F.col(f"in_{i}").isNotNull(), F.col("text")) if i == at else F.col(f"in_{i}")).alias(c)
        for i, c in enumerate(df.columns)])

"""PII (2): spans of personal data, and information-theoretic sanitisation of the terms that reveal them.

Base spans (email, ip, card, phone) are found by patterns. Each distinct value is a protected entity e, and so is each name, owner and
domain of mail addresses, each network of addresses (/24) and each phone number without its last four digits, which pool the values that
share them. Over the whole corpus, with documents as the unit, p(t) and p(e, t) are counted, t being a word within WITHIN words of
the entity. A term discloses 1 - log p(e | t) / log p(e) of the entity's information: 1 if it appears with nothing else, 0 if it
tells nothing. A term that discloses at least REMOVE of some entity is removed wherever it stands, one that discloses at least GENERALISE
is generalised: a number to its magnitude, a date to its year, any other word to [WORD]. Every entity and every term beside it counts.

Chance must not decide: p(e | t) is the lower end of its (Wilson) confidence interval, at an error of ALPHA shared by all pairs that were
looked at, over as many observations as the pair has different surroundings: texts count as one if they share the most frequent of their SKETCHES least
shingle hashes, as near copies do. So a pair seen once discloses little, whatever the size of the corpus. p(e) is the entity's share of the
surroundings of all entities and UNSEEN more. Neither repeating every document nor adding text without entities or these terms changes a verdict.

Null and empty texts have no spans. Spans belong to a text (they are joined by its digest), so repeated rows and doc_ids are
rows of their own. An empty table gives an empty result. Only doc_id and text are read (redact keeps the other columns).
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections import Counter
from statistics import NormalDist

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from speedloom.llm.common import HASHES, M1, bit_filter, long_lists, mixed, passes, raw, shingle_hashes, slices, stage, strings
from speedloom.llm.decontam import words_of

KINDS = ("email", "ip", "card", "phone", "general", "removed")
#: What stands in a redacted text for a span of each kind.
PLACEHOLDERS = ("[EMAIL]", "[IP]", "[CARD]", "[PHONE]", "[WORD]", "[REMOVED]")
#: Names of helper columns that no table has.
KEY, MARKS = "__pii_digest", "__pii_spans"
WITHIN = 10
#: Share of corpora of chance in which any pair may pass; surroundings of entities that the corpus does not show.
ALPHA, UNSEEN = 0.05, 1000
#: Least hashes of five-word shingles that a text is compared by.
SKETCHES = 8
KEYS = mixed(np.arange(1, SKETCHES + 1, dtype=np.uint64) * M1)[:, None]
GENERALISE, REMOVE = 0.85, 0.95

LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+){3}")  # a later start in a run of digits matches only if its first does
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
WORD = re.compile("[0-9A-Za-z\x80-\U0010ffff]+")
NOT_DIGIT = re.compile("[^0-9]")
NOT_LETTER = re.compile("[^a-z]")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        n = int(c) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def emails(text: str):
    """Leftmost matches; the local part is the whole run before the at sign, so a run is looked at once."""
    done, at = 0, text.find("@")
    while at >= 0:
        begin = at
        while begin > done and text[begin - 1] in LOCAL:
            begin -= 1
        match = DOMAIN.match(text, at + 1) if begin < at else None
        if match:
            yield begin, match.end()
        done = match.end() if match else at + 1
        at = text.find("@", done)


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """start, number of the kind, end of each base span, by start and kind."""
    out = [(a, 0, b) for a, b in emails(text)] if "@" in text else []
    if "." in text:
        out += [(m.start(), 1, m.end()) for m in IP.finditer(text) if all(len(x := p.lstrip("0")) <= 3 and int(x or "0") <= 255 for p in m[0].split("."))]
    out += [(m.start(), 2, m.end()) for m in CARD.finditer(text) if 14 <= len(d := NOT_DIGIT.sub("", m[0])) <= 19 and luhn(d)]
    if "+" in text:
        out += [(m.start(), 3, m.end()) for m in PHONE.finditer(text) if 10 <= len(NOT_DIGIT.sub("", m[0])) <= 15]
    return sorted(out)


SPAN = pa.list_(pa.struct([("start", pa.int64()), ("kind", pa.int32()), ("end", pa.int64())]))
NEAR = pa.list_(pa.struct([("entities", pa.list_(pa.string())), ("terms", pa.list_(pa.string()))]))


def entity_of(kind: int, value: str) -> str:
    return f"{kind}:" + (value.lower() if kind == 0 else value if kind == 1 else NOT_DIGIT.sub("", value))


def entities_of(kind: int, value: str) -> list[str]:
    """The exact value, and what it shares with other values: name, owner and domain of an email, network of an ip, line of a phone."""
    out = [entity_of(kind, value)]
    if kind == 0:
        name, domain = value.lower().split("@", 1)
        owner = NOT_LETTER.sub("", name.split("+", 1)[0])
        out += [f"name:{name}", f"domain:{domain}"] + [f"owner:{owner}"] * bool(owner)
    elif kind == 1:
        out.append("network:" + value.rsplit(".", 1)[0])
    elif kind == 3:
        out.append("line:" + NOT_DIGIT.sub("", value)[:-4])
    return out


def joined(spans) -> tuple[list[int], list[int]]:
    """Starts and ends of what the spans (sorted by start) cover, in pieces that do not meet."""
    starts, ends = [], []
    for start, _, end in spans:
        if ends and start < ends[-1]:
            ends[-1] = max(ends[-1], end)
        else:
            starts.append(start)
            ends.append(end)
    return starts, ends


def meets(covered: tuple[list[int], list[int]], start: int, end: int) -> bool:
    at = bisect_left(covered[0], end) - 1  # the last piece that starts before the end
    return at >= 0 and covered[1][at] > start


def terms_around(text: str, spans, within: int) -> list[list[str]]:
    """For each span the distinct whole words among the ``within`` before and after it, without those that touch a span."""
    words = [m.span() for m in WORD.finditer(text)] if spans else []
    begins, ends = [a for a, _ in words], [b for _, b in words]
    covered, out = joined(spans), []
    for start, _, end in spans:
        before, after = bisect_right(ends, start), bisect_left(begins, end)
        beside = words[max(0, before - within) : before] + words[after : after + within]
        out.append(sorted({text[p:q].encode().lower().decode() for p, q in beside if not meets(covered, p, q)}))
    return out


def sketch(text: str, spans, within: int) -> np.ndarray:
    """Least shingle hashes of the words that stand beside no span (of all words if those are few): what goes with an entity says nothing about copies."""
    words = [m.span() for m in WORD.finditer(text)]
    begins, ends = [a for a, _ in words], [b for _, b in words]
    far = np.ones(len(words), bool)
    for start, _, end in spans:
        far[max(0, bisect_right(ends, start) - within) : bisect_left(begins, end) + within] = False
    far |= far.sum() < 10
    kept = [text[a:b].encode().lower() for (a, b), f in zip(words, far.tolist()) if f]
    shingles = shingle_hashes(HASHES.of(kept), 5)
    return np.array([mixed(shingles ^ k).min() for k in KEYS]) if len(shingles) else np.empty(0, np.uint64)


def generalised(word: str) -> str:
    """What a term is part of: a date's year, a number's first digit and size."""
    if word.isascii() and word.isdigit():
        if len(word) == 8 and word[:2] in ("19", "20") and "01" <= word[4:6] <= "12" and "01" <= word[6:] <= "31":
            return word[:4]
        return word[0] + "0" * (len(word) - 1)
    return PLACEHOLDERS[4]


def digest() -> F.Column:
    return F.md5(F.coalesce("text", F.lit(""))).alias("digest")


def found(docs: DataFrame, within: int) -> DataFrame:
    """doc_id, digest of the text, base spans, the entities of each with the words around it, and where there are any least shingle hashes of the text."""

    def rows(batches):
        for batch in batches:
            for part in slices(batch):
                all_spans, near, sketches = [], [], []
                for text in strings(part):
                    spans = base_spans(text)
                    all_spans.append([{"start": a, "kind": k, "end": b} for a, k, b in spans])
                    near.append([{"entities": entities_of(k, text[a:b]), "terms": terms} for (a, k, b), terms in zip(spans, terms_around(text, spans, within))])
                    sketches.append(sketch(text, spans, within) if spans else np.empty(0, np.uint64))
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("digest"), pa.array(all_spans, SPAN), pa.array(near, NEAR), long_lists(sketches)], names=["doc_id", "digest", "spans", "near", "sketch"])

    schema = "doc_id long, digest string, spans array<struct<start:long,kind:int,end:long>>, near array<struct<entities:array<string>,terms:array<string>>>, sketch array<long>"
    return docs.select("doc_id", "text", digest()).mapInArrow(rows, schema)


def term_documents(docs: DataFrame, keys: bytes) -> DataFrame:
    """term, n: documents with each word whose hash passes the filter; summed in each slice before the shuffle."""
    sent = docs.sparkSession.sparkContext.broadcast(keys)

    def rows(batches):
        bits = np.frombuffer(sent.value, np.uint8)
        for batch in batches:
            for part in slices(batch):
                n: Counter[bytes] = Counter()
                for text in raw(part):
                    words = list(set(words_of(text)))
                    if words:
                        n.update(words[i] for i in np.flatnonzero(passes(bits, HASHES.of(words))))
                yield pa.RecordBatch.from_arrays([pa.array([x.decode() for x in n], pa.string()), pa.array(n.values(), pa.int64())], names=["term", "n"])

    return docs.select("text").mapInArrow(rows, "term string, n long").groupBy("term").agg(F.sum("n").alias("n"))


def hashed(terms: DataFrame) -> DataFrame:
    """The terms' hashes as the workers compute them."""

    def rows(batches):
        for batch in batches:
            h = HASHES.of([x.encode() for x in batch.column("term").to_pylist()])
            yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64))], names=["h"])

    return terms.select("term").distinct().mapInArrow(rows, "h long")


def lower_bound(k: F.Column, n: F.Column, z2: float) -> F.Column:
    """Wilson's lower end for k of n at so many squared deviations."""
    p = F.least(k / n, F.lit(1.0))
    return (p + z2 / (2 * n) - F.sqrt(z2 * (p * (1 - p) / n + z2 / (4 * n * n)))) / (1 + z2 / n)


def surroundings_of(seen: DataFrame) -> DataFrame:
    """row, place: one name for texts that share the most frequent of their least shingle hashes."""
    each = seen.select("row", F.posexplode("sketch").alias("k", "h"))
    often = each.groupBy("k", "h").agg(F.count("*").alias("often"))
    return each.join(often, ["k", "h"]).groupBy("row").agg(F.max(F.struct("often", "k", "h")).alias("m")).select("row", F.xxhash64("m.k", "m.h").alias("place"))


def disclosing_terms(docs: DataFrame, seen: DataFrame, generalise: float = GENERALISE, remove: float = REMOVE, alpha: float = ALPHA) -> DataFrame:
    """term, kind (4 to generalise, 5 to remove) of the terms that disclose an entity."""
    near = seen.join(surroundings_of(seen), "row").select("row", "place", F.explode("near").alias("e"))
    near = near.select("row", "place", "e.terms", F.explode("e.entities").alias("entity"))
    pairs = near.select("entity", "row", "place", F.explode("terms").alias("term"))
    pairs = stage(pairs.groupBy("entity", "term").agg(F.countDistinct("row").alias("n_et"), F.countDistinct("place").alias("places")), "pii-pairs")
    size = pairs.count()
    if not size:
        return pairs.select("term", F.lit(0).alias("kind"))
    entities = near.groupBy("entity").agg(F.countDistinct("place").alias("n_e"))
    whole = near.select(F.countDistinct("place")).first()[0]
    counts = term_documents(docs, bit_filter(hashed(pairs), "h"))
    z2 = NormalDist().inv_cdf(1 - min(0.5, alpha / size)) ** 2
    both = pairs.join(counts, "term").join(entities, "entity")
    attested = F.least("n_et", "places").cast("double")
    sure = lower_bound(attested, attested * F.col("n") / F.col("n_et"), z2)
    prior = F.col("n_e") / F.lit(float(max(whole, 1) + UNSEEN))
    both = both.groupBy("term").agg(F.max(1 - F.log(sure) / F.log(prior)).alias("told")).where(F.col("told") >= generalise)
    return both.select("term", F.when(F.col("told") >= remove, 5).otherwise(4).alias("kind"))


def term_places(docs: DataFrame, terms: DataFrame) -> DataFrame:
    """digest, start, kind, end of every occurrence of a disclosing term."""
    sent = docs.sparkSession.sparkContext.broadcast(bit_filter(hashed(terms), "h"))

    def rows(batches):
        bits = np.frombuffer(sent.value, np.uint8)
        for batch in batches:
            for part in slices(batch):
                out: list[tuple] = []
                for name, text in zip(part.column("digest").to_pylist(), raw(part)):
                    words = list(set(words_of(text)))
                    hits = {words[i] for i in np.flatnonzero(passes(bits, HASHES.of(words)))} if words else ()
                    if hits:
                        out += [(name, w.decode(), m.start(), m.end()) for m in WORD.finditer(text.decode()) if (w := m[0].encode().lower()) in hits]
                kinds = [pa.string(), pa.string(), pa.int64(), pa.int64()]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(list(zip(*out)) or [[]] * 4, kinds)], names=["digest", "term", "start", "end"])

    places = docs.select("text", digest()).mapInArrow(rows, "digest string, term string, start long, end long").distinct()
    return places.join(terms, "term").select("digest", "start", F.col("kind").cast("int").alias("kind"), "end")


def private_spans(docs: DataFrame, within: int = WITHIN) -> DataFrame:
    """doc_id, digest, spans (start, kind, end; by start and kind) of every document: base spans and those of disclosing terms."""
    seen = stage(found(docs, within).withColumn("row", F.monotonically_increasing_id()), "pii-found")
    terms = stage(disclosing_terms(docs, seen), "pii-terms")
    more = term_places(docs, terms).groupBy("digest").agg(F.collect_set(F.struct("start", "kind", "end")).alias("more"))

    def rows(batches):
        for batch in batches:
            out = []
            for spans, extra in zip(batch.column("spans").to_pylist(), batch.column("more").to_pylist()):
                if extra:  # a term inside a base span is part of that span
                    covered = joined([(x["start"], x["kind"], x["end"]) for x in spans])
                    spans = sorted(spans + [x for x in extra if not meets(covered, x["start"], x["end"])], key=lambda x: (x["start"], x["kind"], x["end"]))
                out.append(spans)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("digest"), pa.array(out, SPAN)], names=["doc_id", "digest", "spans"])

    both = seen.select("doc_id", "digest", "spans").join(more, "digest", "left").select("doc_id", "digest", "spans", "more")
    return both.mapInArrow(rows, "doc_id long, digest string, spans array<struct<start:long,kind:int,end:long>>")


def span_report(docs: DataFrame) -> DataFrame:
    """doc_id, counts of the base kinds, digest of the base spans, all spans as text."""
    spans = private_spans(docs)
    names = F.array(*map(F.lit, KINDS))
    said = lambda x: F.concat_ws(":", F.get(names, x["kind"]), x["start"].cast("string"), x["end"].cast("string"))
    base = F.filter("spans", lambda x: x["kind"] < 4)
    of_kind = lambda k: F.size(F.filter("spans", lambda x: x["kind"] == k)).cast("long").alias(f"n_{KINDS[k]}")
    count = list(map(of_kind, range(4)))
    return spans.select("doc_id", *count, F.sha2(F.array_join(F.transform(base, said), ","), 256).alias("base_sha256"), F.array_join(F.transform("spans", said), ",").alias("spans"))


def redact(docs: DataFrame) -> DataFrame:
    """The documents, with every span replaced by its kind in brackets (a generalised term by what it is part of) and n_chars counted anew."""
    spans = private_spans(docs).where(F.size("spans") > 0).groupBy(F.col("digest").alias(KEY)).agg(F.first("spans").alias(MARKS))
    columns = docs.columns

    def rows(batches):
        for batch in batches:
            for part in slices(batch):
                out = []
                for text, marks in zip(part.column("text").to_pylist(), part.column(MARKS).to_pylist()):
                    if marks:
                        done, pieces = 0, []
                        for x in marks:
                            if x["end"] > done:
                                if x["start"] >= done:
                                    word = text[x["start"] : x["end"]]
                                    pieces += [text[done : x["start"]], generalised(word) if x["kind"] == 4 else PLACEHOLDERS[x["kind"]]]
                                done = x["end"]
                        text = "".join(pieces) + text[done:]
                    out.append(text)
                at = part.schema.get_field_index("text")
                yield part.set_column(at, part.schema.field(at), pa.array(out, part.schema.field(at).type)).select(columns)

    clean = docs.join(spans.hint("merge"), digest() == F.col(KEY), "left").drop(KEY).mapInArrow(rows, docs.schema)
    return clean.withColumn("n_chars", F.length("text").cast(dict(docs.dtypes)["n_chars"])) if "n_chars" in docs.columns else clean

"""Quality rules, PII, HTML text, decontamination and token counts against brute force."""

from __future__ import annotations

import hashlib
import itertools
import math
import random
import re
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from speedloom.llm import decontam, html_text, pii, quality, tokencount
from tests.llm.conftest import LONG, ODD


def by_id(df):
    return {r.doc_id: r for r in df.collect()}


def base_counts(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    again = {w for w in windows if windows.count(w) > 1} if len(words) < 3000 else {w for w, n in __import__("collections").Counter(windows).items() if n > 1}
    hit = {j for i, w in enumerate(windows) if w in again for j in range(i, i + 3)}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), dup, len(hit)


def check_rules(docs, texts, labels):
    got = by_id(quality.quality_rules(docs, labels))
    assert got.keys() == texts.keys()
    for i, text in texts.items():
        r, want = got[i], base_counts(text)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want
        assert r.base_failed == (want[0] < 50 or 100 * want[4] > 50 * want[0])
        assert r.kept == (not r.base_failed and r.llr >= quality.THRESHOLD)
    return got


def test_quality_rules(spark, sf_dir, documents, odd, empty):
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    texts = {r.doc_id: r.text for r in documents.collect()}
    got = check_rules(documents, texts, labels)
    good = {r.doc_id for r in labels.where("quality = 1").collect()}
    counts = {}
    for name, ids in (("raw", texts), ("good", good & texts.keys())):
        counts[name] = np.zeros(1 << quality.BUCKET_BITS)
        for i in ids:
            np.add.at(counts[name], quality.buckets(texts[i].encode().split() or [b""], quality.BUCKET_BITS) if texts[i].split() else [], 1)
    ratio = np.log((counts["good"] + 5) / (counts["raw"] * counts["good"].sum() / counts["raw"].sum() + 5))
    for i in list(texts)[:60]:
        words = texts[i].encode().split()
        assert got[i].llr == pytest.approx(ratio[quality.buckets(words, quality.BUCKET_BITS)].mean() if words else 0)
    bad = [r for r in labels.where("quality = 0").collect() if r.doc_id in got]
    assert sum(got[r.doc_id].kept for r in bad) < 0.2 * len(bad)
    kept = [got[i].kept or got[i].base_failed for i in good & got.keys()]
    assert sum(kept) > 0.97 * len(kept)
    check_rules(odd, dict(enumerate(ODD)), labels.where("false"))
    assert quality.quality_rules(empty, labels).count() == 0


CASES = {
    "a.b+c@x-y.co.uk, d@e and f@g.h..": [("email", 0, 15), ("email", 25, 30)],
    "@@a@b.c@d.e": [("email", 2, 7)],
    "1.2.3.4 256.1.1.1 00001.2.3.255 1.2.3.4.5": [("ip", 0, 7), ("ip", 18, 31), ("ip", 32, 39)],
    "4111 1111-1111 1111 and 4111 1111 1111 1112": [("card", 0, 19)],
    "+1 (988) 555-2485 +12": [("phone", 0, 17)],
    "é +44 20 7946 0958.": [("phone", 2, 18)],
    "x" * 50_000 + "9" * 50_000: [],
}
SLOW = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def slow_spans(text):
    out = []
    for kind, pattern in SLOW.items():
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            fine = {
                "email": True, "ip": kind == "ip" and all(int(p) <= 255 for p in m[0].split(".") if p.isdigit()), "phone": 10 <= len(digits) <= 15,
                "card": 14 <= len(digits) <= 19 and sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(digits[::-1])) % 10 == 0,
            }[kind]
            if fine:
                out.append((m.start(), list(SLOW).index(kind), m.end()))
    return sorted(out)


def test_base_spans(documents):
    for text, want in CASES.items():
        assert [(pii.KINDS[k], a, b) for a, k, b in pii.base_spans(text)] == want
    for r in documents.collect():
        assert pii.base_spans(r.text) == slow_spans(r.text)
    for chars in itertools.product("a@.1+ -", repeat=5):
        text = "".join(chars) * 2
        assert pii.base_spans(text) == slow_spans(text), text


def planted(entities=20, times=30, seed=3):
    """Documents in which a code name is only ever said beside one address, in surroundings of random words, and plain ones."""
    rng = random.Random(seed)
    words = ["".join(rng.choice("bcdfglmnrst") + rng.choice("aeiou") for _ in range(rng.randint(1, 3))) for _ in range(600)]
    told = lambda n: " ".join(rng.choice(words) for _ in range(n))
    codes = [f"zz{i}kestrel" for i in range(entities)]
    near = [f"{told(25)} {codes[i]} writes from box{chr(97 + i)}@mail{i}.example {told(25)}" for i in range(entities) for _ in range(times)]
    plain = [told(60) for _ in range(400)] + [f"{told(25)} {told(1)}@host{rng.randint(0, 400)}.example {told(25)}" for _ in range(400)]
    return codes, near, plain


def verdicts(docs):
    seen = pii.found(docs, pii.WITHIN).withColumn("row", F.monotonically_increasing_id())
    return {r.term: r.kind for r in pii.disclosing_terms(docs, pii.stage(seen, "pii-found")).collect()}


def test_pii_terms_tied_to_an_entity_are_found_and_chance_is_not(frame):
    codes, near, plain = planted()
    terms = verdicts(frame(near + plain))
    assert len(set(codes) & set(terms)) >= 0.9 * len(codes)
    assert set(terms) <= {*codes, "writes", "from"} | set()
    rows = by_id(pii.span_report(frame(near + plain)))
    assert sum(bool(rows[i].spans.replace("email:", "").count("general") + rows[i].spans.count("removed")) for i in range(len(near), len(rows))) <= 0.01 * len(plain)
    kind = pii.KINDS[terms[codes[0]]]
    at, mail = near[0].index(codes[0]), near[0].index("boxa@")
    assert rows[0].spans.split(",") == [f"{kind}:{at}:{at + len(codes[0])}", f"email:{mail}:{near[0].index(' ', mail)}"]
    assert rows[0].n_email == 1 and rows[0].base_sha256 == hashlib.sha256(f"email:{mail}:{near[0].index(' ', mail)}".encode()).hexdigest()


def test_pii_verdicts_do_not_hang_on_the_size_of_the_corpus(frame):
    codes, near, plain = planted(entities=6)
    terms = verdicts(frame(near + plain))
    assert set(codes) <= set(terms)
    assert verdicts(frame((near + plain) * 2)) == terms  # every document twice
    assert verdicts(frame(near + plain + [f"lorem ipsum dolor {i}" for i in range(3000)])) == terms  # unrelated text
    # one sighting proves nothing, and neither do copies of one text or near copies
    once = [x for k, x in enumerate(near) if k % 30 == 0]
    assert verdicts(frame(once + plain)) == verdicts(frame(once * 40 + plain)) == {}
    rng = random.Random(1)
    edited = [" ".join(rng.choice("xyz") if rng.random() < 0.02 else w for w in near[0].split()) for _ in range(200)]
    assert not {t for t in verdicts(frame(edited + plain)) if t not in near[0].split()[20:32]}


def test_pii_odd_texts(frame, odd, empty):
    got = by_id(pii.span_report(odd))
    assert len(got) == len(ODD) and got[0].spans == got[1].spans == ""
    assert {r.doc_id: r.text for r in pii.redact(odd).collect()} == dict(enumerate(ODD))
    assert pii.span_report(empty).count() == pii.redact(empty).count() == 0


def test_pii_generalises_what_can_be(frame, monkeypatch):
    assert [pii.generalised(x) for x in ("37512", "7", "20240315", "20241399", "kestrel")] == ["30000", "7", "2024", "20000000", "[WORD]"]
    monkeypatch.setattr(pii, "disclosing_terms", lambda docs, seen: docs.sparkSession.createDataFrame([("4711", 4), ("kestrel", 5), ("osprey", 4)], "term string, kind int"))
    rows = {r.doc_id: r for r in pii.redact(frame(["no 4711 of kestrel and osprey at a@b.example", "plain"])).collect()}
    assert rows[0].text == "no 4000 of [REMOVED] and [WORD] at [EMAIL]" and rows[0].n_chars == len(rows[0].text) and rows[1].text == "plain"
    assert pii.entities_of(0, "Jane.Doe+x@A.example") == ["0:jane.doe+x@a.example", "name:jane.doe+x", "domain:a.example", "owner:janedoe"]


def test_pii_many_spans_in_one_text():
    text = " ".join(f"user{i}@host{i % 97}.example said w{i}" for i in range(40_000))
    start = time.time()
    spans = pii.base_spans(text)
    near = pii.terms_around(text, spans, 10)
    assert len(spans) == len(near) == 40_000 and "said" in near[7] and not any("user" in t for t in near[9])
    assert time.time() - start < 20


def test_terms_beside_a_span_are_whole_words():
    run, url = "語" * 900, "k" * 700
    text = f"first {run} 10.1.2.3 {url} last 10.1.2.4x end"
    assert pii.terms_around(text, pii.base_spans(text), 10)[0] == sorted(["first", run, url, "last", "end"])
    assert pii.terms_around("a b c d@e.f g h i", [(6, 0, 11)], 2) == [["b", "c", "g", "h"]]
    assert pii.terms_around("plain", [], 10) == []


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var a="</p>";</script></head><body>
<header class="site-header"><h1>Site</h1></header><nav><ul><li><a href="/a">A</a><li><a>B</a></ul></nav><div class="cookie-notice"><p>We use cookies on this site, accept them please now.</p></div>
<article><h1>Title &amp; more</h1><p>First   paragraph<br>goes on here &lt;b&gt; with words.<p>Second <b>bold paragraph</b> that has no end <div>Third block here, with enough words in it.</div>
<form><input name=q><button>Go</button></form><p>Yes.</p></article>
<div id="comments"><p>Great article, I really liked reading the whole of it today!</p></div><aside>Related</aside><div class=ad>Buy</div><footer>&copy; me</footer>"""


def test_html_text(spark, sf_dir):
    assert html_text.main_text(PAGE).split("\n") == ["Title & more", "First paragraph goes on here <b> with words.", "Second bold paragraph that has no end", "Third block here, with enough words in it.", "Yes."]
    plain = "<div><p>" + "A long paragraph of plain words goes on and on, as articles do, without any link in it at all. " * 2 + "</p></div><ul><li><a>Home</a></li><li><a>About</a></li></ul>"
    assert html_text.main_text(plain).startswith("A long") and "Home" not in html_text.main_text(plain)
    odd = [None, "", "<", "<p", "a < b", "<p>" * 3000 + "x", "</p></p>", "<a href='x>y", "<!-- never closed"]
    rows = spark.createDataFrame([(i, "u", x, 1) for i, x in enumerate(odd)], "page_id long, url string, html string, text int")
    got = {r.page_id: r for r in html_text.extract(rows).collect()}
    assert len(got) == len(odd) and got[0].text == "" and all(r.n_chars == len(r.text) for r in got.values())
    assert html_text.extract(rows.where("false")).count() == 0
    for r in spark.read.parquet(f"{sf_dir}/pages.parquet").limit(40).collect():
        inside = re.search("<article>(.*)</article>", r.html, re.S)[1]
        words = html_text.html.unescape(re.sub("<[^>]*>", " ", inside)).split()
        assert html_text.main_text(r.html).split() == words


def test_minimum_cut_is_minimal():
    rng = np.random.default_rng(1)
    for _ in range(150):
        n = int(rng.integers(1, 8))
        costs = rng.integers(-6, 7, n).tolist()
        ties = {(i, j): int(rng.integers(0, 6)) for i in range(n) for j in range(i + 1, n) if rng.random() < 0.5}

        def total(side):
            return sum(abs(c) for c, s in zip(costs, side) if s != (c > 0) and c) + sum(c for (i, j), c in ties.items() if side[i] != side[j])

        best = min(map(total, itertools.product([False, True], repeat=n)))
        assert total(html_text.minimum_cut(costs, ties)) == best


def slow_contamination(texts, items):
    words = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    out = {}
    for i, text in texts.items():
        w, hit, found = words(text), set(), set()
        at = {}
        for size in range(1, 14):
            for p in range(len(w) - size + 1):
                at.setdefault(tuple(w[p : p + size]), []).append(p)
        for item, t in items:
            x = words(t)
            n = min(13, len(x))
            for p in range(len(x) - n + 1 if x else 0):
                for q in at.get(tuple(x[p : p + n]), ()):
                    hit.update(range(q, q + n))
                    found.add(item)
        sha = hashlib.sha256(",".join(sorted(map(str, found))).encode()).hexdigest()
        out[i] = (len(w), len(hit), len(found), sha, bool(hit) and 20 * len(hit) >= len(w))
    return out


@pytest.mark.parametrize("small", [False, True])
def test_decontamination(spark, sf_dir, documents, frame, small):
    if small:
        texts = ["alpha beta gamma", "Alpha, BETA delta " * 3, None, "", "x y z " * 9, " ".join(f"v{i}" for i in range(60)), "é1 É2 é1"]
        docs = frame(texts)
        texts = dict(enumerate(texts))
        items = [(1, "alpha beta"), (10, "alpha"), (2, None), (3, "!!"), (4, " ".join(f"v{i}" for i in range(20, 45))), (5, " ".join(f"v{i}" for i in range(20, 45))), (6, "x y z " * 6), (7, "É2 é1")]
    else:
        docs = documents
        texts = {r.doc_id: r.text for r in docs.where("length(text) < 8000").collect()}
        items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    bench = spark.createDataFrame([(*x, "w") for x in items], "item_id long, text string, window string")
    got = by_id(decontam.decontaminate(docs, bench))
    want = slow_contamination(texts, items)
    assert {i: (got[i].n_words, got[i].n_hit, got[i].n_items, got[i].items_sha256, got[i].contaminated) for i in want} == want
    assert any(x[1] for x in want.values())


def test_decontamination_of_odd_tables(spark, odd, empty):
    bench = spark.createDataFrame([(1, LONG)], "item_id long, text string")
    got = by_id(decontam.decontaminate(odd, bench))
    assert got[7].contaminated and got[7].n_hit == got[7].n_words == 80_000 and got[0].n_words == 0
    assert not any(r.contaminated for r in decontam.decontaminate(odd, bench.where("false")).collect())
    assert decontam.decontaminate(empty, bench).count() == 0


def test_token_counts(documents, odd, empty):
    pieces, unknown = tokencount.unigram_pieces()

    def slow(word):
        best = [(0.0, 0)]
        for end in range(1, len(word) + 1):
            size = len(word[end - 1].encode())
            options = [(best[end - 1][0] + unknown * size, best[end - 1][1] - size)]
            options += [(best[b][0] + pieces[word[b:end]], best[b][1] - 1) for b in range(end) if word[b:end] in pieces]
            best.append(max(options))
        return -best[-1][1]

    for docs, texts in ((documents, {r.doc_id: r.text for r in documents.where("length(text) < 3000").collect()}), (odd, {i: x for i, x in enumerate(ODD[:-1]) if x != LONG})):
        got = by_id(tokencount.token_counts(docs))
        for i, text in texts.items():
            words = (text or "").split()
            assert (got[i].n_pretokens, got[i].n_tokens) == (len(words), sum(slow("▁" + w) for w in words))
    assert tokencount.token_counts(empty).count() == 0
    assert math.isclose(sum(math.exp(x) for x in pieces.values()), 1)

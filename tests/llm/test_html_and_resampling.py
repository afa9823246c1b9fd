"""Main text of pages and importance resampling, against plain readings of their rules."""

import hashlib
import html
import math
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from runloom.llm import queries as q
from runloom.llm.html_extraction import LABELLED_PAGES, best_region, extract_main_text, feature_counts, main_text, weights_from
from runloom.llm.importance_resampling import collapsed, ngram_patterns, resample

SMALL = "/root/testdata/sf0.001"
PROSE = "The quick water of the river runs to the sea and never comes back again."
CLASHES = ["_key", "_text", "_html", "_words", "_counts", "weight", "score", "rank", "feature", "n"]


@pytest.fixture(scope="module")
def fixed():
    counts = Counter()
    for page in LABELLED_PAGES:
        counts.update(feature_counts(page))
    return weights_from(counts)


def article_of(page):
    """The article of the given pages, which are of one plain form."""
    inside = re.search(r"<article>(.*?)</article>", page, re.S)[1]
    lines = re.sub(r"</?b>", "", re.sub(r"</?(?:p|h1)>", "\n", inside.replace("<br>", " "))).split("\n")
    return "\n".join(t for t in (" ".join(html.unescape(line).split()) for line in lines) if t)


def test_articles_of_the_given_pages(spark):
    pages = {r.page_id: r for r in spark.read.parquet(f"{SMALL}/pages.parquet").collect()}
    rows = q.QUERIES["op12_html_extraction"](spark, SMALL).collect()
    assert len(rows) == len(pages)
    for r in rows:
        assert r.text == article_of(pages[r.page_id].html) and r.n_chars == len(r.text) and r.url == pages[r.page_id].url


def test_other_layouts(fixed):
    page = (
        f"<body><nav><a href=x>Menu one</a></nav><article><header><h1>Title &amp; more</h1><p>by someone</p></header><p>{PROSE}<p>{PROSE} &lt;b&gt;"
        "<aside>Related thing</aside><div class='ad-box'>Buy</div><form><label>Mail</label></form><p>a&nbsp;b<br>c<b>d</b>e</article>"
        "<div id=comments><article class=comment><p>Nice article, I liked it a lot indeed, thanks for it</p></article></div><footer>&copy; x</footer>"
    )
    assert main_text(page, fixed).split("\n") == ["Title & more", PROSE, f"{PROSE} <b>", "a b cde"]
    page = f"<div class='cookie-notice'>{PROSE}</div><div id=content><h2>Head</h2><div>{PROSE}</div></div><div class=sidebar><p>{PROSE}</p></div>"
    assert main_text(page, fixed) == f"Head\n{PROSE}"
    page = f"<p>{PROSE}</p><script>if (a<b) document.write('<p>x</p>')</script><p style='display: none'>gone</p><p>a < b and so on"
    assert main_text(page, fixed) == f"{PROSE}\na < b and so on"
    assert main_text(f"<div class='site-header-wrap sidebar'><p>{PROSE}</p></div>", fixed) == PROSE
    assert main_text(f"<div class=ad>never closed<article><p>{PROSE}</p></article>", fixed) == PROSE
    assert [main_text(t, fixed) for t in (None, "", "<p>", "<!-- open <p>x</p>", "<a " * 50_000)] == [""] * 5
    assert main_text("<b>" * 20_000 + "word " + "<div></div>" * 20_000, fixed) == "word"


def test_region_is_the_best_of_all():
    class Piece:
        def __init__(self, words, tags):
            self.words, self.before, self.inline, self.feature, self.part = words, [("t", False)] * tags, [], "w", ""

    weights = {"w": 1.0, "t": -2.0}
    for seed in range(200):
        digits = hashlib.sha256(str(seed).encode()).digest()
        blocks = [Piece(digits[i] % 7 + 1, digits[i + 16] % 5) for i in range(seed % 12 + 1)]
        worth = lambda a, b: sum(x.words for x in blocks[a:b]) - 2 * sum(len(x.before) for x in blocks[a + 1 : b])
        a, b = best_region(blocks, weights)
        assert worth(a, b) == max(worth(i, j) for i in range(len(blocks)) for j in range(i + 1, len(blocks) + 1))


def test_odd_pages(spark):
    rows = [(1, "u", f"<article><p>{PROSE}</p></article>"), (1, "u", f"<article><p>{PROSE}</p></article>"), (2, None, None), (None, "v", ""), (3, "w", f"<p>{PROSE}</p>" * 5_000)]
    table = spark.createDataFrame(rows, "page_id long, url string, html string").select("*", *[F.lit(1).alias(c) for c in CLASHES])
    got = sorted((r.page_id or 0, r.url or "", len(r.text), r.n_chars) for r in extract_main_text(table).collect())
    n = len(PROSE)
    assert got == [(0, "v", 0, 0), (1, "u", n, n), (1, "u", n, n), (2, "", 0, 0), (3, "w", 5_000 * (n + 1) - 1, 5_000 * (n + 1) - 1)]
    assert extract_main_text(table.limit(0)).collect() == []


def features(text, longest):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
    return words, [" ".join(words[i : i + n]) for n in range(1, longest + 1) for i in range(len(words) - n + 1)]


def brute_resample(docs, target, longest, buckets, least, percent, seed):
    hashed = {f: zlib.crc32(f.encode()) % buckets for t in [*[t for _, t in docs], *target] for f in features(t, longest)[1]}
    s, t = (Counter(hashed[f] for x in texts for f in features(x, longest)[1]) for texts in ([x for _, x in docs], target))
    total_s, total_t = sum(s.values()), sum(t.values())
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1) * (total_s + buckets) / ((s[b] + 1) * (total_t + buckets))))
    rows = []
    for doc_id, text in docs:
        words, found = features(text, longest)
        weight = sum(gain(hashed[f]) for f in found) // len(found) if found else 0
        h = int(hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        rows.append([doc_id, len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32))), len(words)])
    able = sorted((r for r in rows if r[4] >= least), key=lambda r: (-r[3], r[0] is not None, r[0] or 0))
    ranks = {id(r): i + 1 for i, r in enumerate(able[: percent * len(able) // 100])}
    return sorted(((r[0], r[1], r[2], r[3], ranks.get(id(r))) for r in rows), key=repr)


@pytest.mark.parametrize("longest", [1, 2, 3])
def test_resampling_by_hand(spark, longest):
    source = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()]
    source += [(-1, None), (-2, ""), (-3, " ,;- "), (None, "É é ÀB a-b 7x7 " * 9), (-4, "Long text. " * 30_000)]
    docs = spark.createDataFrame(source, "doc_id long, text string").select("*", *[F.lit(1).alias(c) for c in CLASHES])
    aims = [r.text for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()] + [None]
    target = spark.createDataFrame([(t,) for t in aims], "text string")
    got = resample(docs, target, longest=longest, buckets=997, least_words=12, percent=30, seed=7)
    assert sorted((tuple(r) for r in got.collect()), key=repr) == brute_resample(source, aims, longest, 997, 12, 30, 7)


def test_spans_and_empty_tables(spark):
    line = collapsed("One, two;THREE\nfour Ä")
    assert line.decode() == "one two three four Ä"
    assert [[m.group().decode() for m in p.finditer(line, overlapped=True)] for p in ngram_patterns(2)] == [
        ["one", "two", "three", "four", "Ä"], ["one two", "two three", "three four", "four Ä"],
    ]
    docs = spark.createDataFrame([(1, "a b"), (1, "a b"), (2, "c " * 30)], "doc_id long, text string")
    none = docs.limit(0)
    assert resample(none, docs).collect() == []
    rows = resample(docs, none, percent=100, least_words=1).collect()
    assert sorted(r.rank for r in rows) == [1, 2, 3] and len({r.score for r in rows if r.doc_id == 1}) == 1

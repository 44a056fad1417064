"""Many languages, long runs of one token, odd blanks, small packings, awkward pages, and columns called like inner ones."""

from __future__ import annotations

import itertools
import math
import random
import re
import time
from collections import Counter

import numpy as np
import pytest
from conftest import SPACED  # noqa: F401
from pyspark.sql import functions as F

from givingledger.llm import contamination, html_text, language, near_duplicates, packing, quality, secrets, token_files
from givingledger.llm.common import fresh_names
from givingledger.llm.queries import vocabulary_path

FOLDER = "/root/testdata/sf0.001"


def test_languages_in_blocks(spark):
    """300 languages, each with its own letters: the result does not depend on the blocks."""
    rows = [(10 * i + k, " ".join(chr(0x4E00 + 20 * i + (7 * j + k) % 20) * 2 for j in range(12)), f"l{i:03d}") for i in range(300) for k in range(3)]
    docs = spark.createDataFrame([*rows, (5001, None, "l000"), (5002, "123", "l001")], "doc_id long, text string, lang string")
    models = language.fit(docs)
    assert [len(m.languages) for m in models] == [256, 44]
    whole = language.fit(docs, block=1000)
    found = sorted(language.predict(docs, models).collect(), key=lambda r: r.doc_id)
    expected = sorted(language.predict(docs, whole).collect(), key=lambda r: r.doc_id)
    assert [(r.doc_id, r.lang_pred) for r in found] == [(r.doc_id, r.lang_pred) for r in expected]
    assert all(math.isclose(a.score, b.score, rel_tol=1e-9) for a, b in zip(found, expected, strict=True))
    assert sum(r.lang_pred == r.lang for r in found) >= 890 and [r.lang_pred for r in found[-2:]] == ["und", "und"]


def test_language_scores_against_plain_python(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").filter("lang IS NOT NULL").limit(60)
    (model,) = language.fit(docs)
    for row in language.predict(docs, [model]).collect()[:12]:
        text = "".join(c if c.isalpha() else " " for c in row.text.lower())
        counts = Counter()
        for order in language.ORDERS:
            for i in range(len(text) - order + 1):
                gram = text[i : i + order]
                if gram[0] != " " or gram[-1] != " ":
                    h = order
                    for c in gram:
                        h = ((h ^ ord(c)) * 0x9E3779B1) & 0xFFFFFFFF
                        h ^= h >> 15
                    counts[h & (model.weights.shape[1] - 1)] += 1
        totals = [int(p) + sum(int(w[b]) * n for b, n in counts.items()) for w, p in zip(model.weights, model.priors, strict=True)]
        assert row.lang_pred == model.languages[totals.index(max(totals))]
        assert math.isclose(row.score, 1 / sum(math.exp((t - max(totals)) / language.SCALE) for t in totals), rel_tol=1e-9)


def test_unlabelled_documents_are_not_dropped_silently(spark, docs, no_docs):
    with pytest.raises(ValueError, match="no language"):
        language.accepted(docs.withColumn("lang", F.lit(None).cast("string")))
    assert language.accepted(no_docs).collect() == []


def test_token_rule_is_linear():
    pattern = re.compile(secrets.RULES["jwt"], re.ASCII)
    start = time.process_time()
    assert not list(pattern.finditer("eyJ" * 400_000))
    assert time.process_time() - start < 2
    token = "eyJ" + "a" * 12 + "." + "b-_" * 4 + "." + "c" * 20
    assert [m.span() for m in pattern.finditer(f"x {token} y")] == [(2, 2 + len(token))]


def test_pieces_put_together_are_the_tokenizers_ids():
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(vocabulary_path())
    encoder = token_files.Encoder(vocabulary_path(), np.dtype("<u2"), 2)
    random.seed(7)
    parts = ["a", "word", "I'll", "é", "日本", "12", "...", "x1", " ", " ", " ", "\n", "\n", "  ", "\t", "\x1c", "\xa0", "\u2028", "\r\n", "<|endoftext|>"]
    weights = [6, 6, 2, 2, 1, 2, 2, 2, 12, 12, 12, 4, 4, 1, 0.3, 0.2, 0.2, 0.2, 0.2, 0.1]
    texts = ["".join(random.choices(parts, weights, k=random.randrange(14))) for _ in range(60_000)] + ["", None]
    texts += [" ".join(random.choices(parts[:8], k=9)) + "\n\n" + "b c\nd" for _ in range(500)]
    import pyarrow as pa
    import pyarrow.compute as pc

    assert pc.sum(pc.invert(pc.match_substring_regex(pa.array(texts, pa.string()), token_files.ODD))).as_py() > 7000
    whole = tokenizer.encode_batch([t or "" for t in texts], add_special_tokens=False)
    found = []
    for i in range(0, len(texts), 997):
        coded, counts = encoder.encode_all(pa.array(texts, pa.string()).slice(i, 997))
        found += [x.tolist() for x in np.split(np.frombuffer(coded, dtype="<u2"), np.cumsum(counts)[:-1])]
    for text, ids, expected in zip(texts, found, whole, strict=True):
        assert ids == [*expected.ids, 2], text


def partitions(items):
    if not items:
        yield []
        return
    for rest in partitions(items[1:]):
        yield [[items[0]], *rest]
        for i in range(len(rest)):
            yield [*rest[:i], [items[0], *rest[i]], *rest[i + 1 :]]


def test_packing_against_all_packings():
    random.seed(3)
    gained = 0
    for _ in range(150):
        permitted = tuple(sorted(random.sample([4, 6, 8, 12, 16, 24], random.randint(1, 4))))
        lengths = sorted((random.randint(1, permitted[-1]) for _ in range(random.randint(1, 7))), reverse=True)
        bins = packing.pack(lengths, permitted)
        assert sorted(p for _, places in bins for p in places) == list(range(len(lengths)))
        assert all(sum(lengths[p] for p in places) <= size for size, places in bins)
        price = sum(packing.cost(size) for size, _ in bins)
        options = (sum(min((packing.cost(s) for s in permitted if s >= sum(b)), default=math.inf) for b in split) for split in partitions(lengths))
        best = min(options)
        fixed = packing.pack_preferring(min(permitted, key=lambda s: (packing.cost(s) / s, s)), lengths, permitted)
        assert best <= price + 1e-9 <= sum(packing.cost(size) for size, _ in fixed) + 2e-9
        assert price <= 1.7 * best
        gained += price < sum(packing.cost(size) for size, _ in fixed) - 1e-9
    mixed = [1500] * 40 + [400] * 40 + [90] * 50
    fixed = packing.pack_preferring(2048, mixed, packing.LENGTHS)
    assert sum(packing.cost(s) for s, _ in packing.pack(mixed, packing.LENGTHS)) <= sum(packing.cost(s) for s, _ in fixed)
    assert gained


@pytest.mark.parametrize(("source", "text"), [
    ("<article><p>One <a href=/it's>link</a> two.</p><p>Next.</p></article>", "One link two.\nNext."),
    ("""<article><p class="a"">Stray quote here.</p><p title='x>y'>Kept whole.</p></article>""", "Stray quote here.\nKept whole."),
    ("<article><p>Main words stand here.</p><div class='comments'><article class='comment'><p>Reader says hi</p></article></div></article>", "Main words stand here."),
    ("<article><p>Main words stand here.</p></article><section id=comments><article><p>Reader says hi</p></article></section>", "Main words stand here."),
    ("<main class='with-sidebar'><p>Main words stand here.</p></main>", "Main words stand here."),
    ("<article class='legal news'><p>Main words stand here.</p></article>", "Main words stand here."),
    ("<div class='page sidebar-left'><main><p>Main words stand here.</p></main></div><nav><p>Menu</p></nav>", "Main words stand here."),
])
def test_awkward_pages(source, text):
    """With the fixed pseudo counts alone."""
    assert html_text.main_text(source, html_text.make_model(html_text.prior_counts())) == text


def test_stripped_pages_keep_their_text(spark):
    """Held-out pages without the tags and words that mark their main text give the text that they give with them."""
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet").select("page_id", "url", "html")
    model = html_text.fit(pages.filter("page_id % 2 = 0"))
    held_out = pages.filter("page_id % 2 = 1").collect()
    same = 0
    for page in held_out:
        stripped = re.sub(r"<(/?)(article|main)\b", r"<\1div", page.html or "")
        stripped = re.sub(r"\s(class|id|role)=(\"[^\"]*\"|'[^']*')", lambda m: m.group() if set(re.findall("[a-z]+", m.group().lower())) & html_text.NOISY_WORDS else "", stripped)
        same += html_text.main_text(stripped, model) == html_text.main_text(page.html, model)
    assert same >= 0.98 * len(held_out)


def test_pages_with_many_quotes_take_linear_time():
    start = time.process_time()
    html_text.tree("<p " + "a='\" " * 100_000 + "<p =" * 50_000)
    html_text.tree("<a href=" + " =" * 200_000)
    assert time.process_time() - start < 10


def test_quality_scores_against_plain_python(spark):
    import xxhash

    docs, labels = (spark.read.parquet(f"{FOLDER}/{t}.parquet") for t in ("documents", "labels"))
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    h1 = lambda w: xxhash.xxh64_intdigest(w.encode(), seed=42)
    h2 = lambda a, b: signed(xxhash.xxh64_intdigest(signed(b).to_bytes(8, "little", signed=True), seed=xxhash.xxh64_intdigest(signed(a).to_bytes(8, "little", signed=True), seed=42)))
    good = {r.doc_id for r in labels.filter("quality = 1 AND coalesce(toxic, 0) = 0").collect()}
    counts, grams = {"raw": np.ones(1 << 14), "trusted": np.ones(1 << 14)}, {}
    for row in docs.collect():
        hashes = [h1(w) for w in SPACED.findall(row.text or "")]
        grams[row.doc_id] = [signed(h) % (1 << 14) for h in hashes] + [h2(a, b) % (1 << 14) for a, b in itertools.pairwise(hashes)]
        np.add.at(counts["raw"], grams[row.doc_id], 1)
        if row.doc_id in good:
            np.add.at(counts["trusted"], grams[row.doc_id], 1)
    weights = np.log(counts["trusted"] / counts["trusted"].sum()) - np.log(counts["raw"] / counts["raw"].sum())
    for row in quality.judge(docs, labels).collect():
        score = weights[grams[row.doc_id]].sum() / max(len(grams[row.doc_id]), 1)
        assert abs(row.score - score) < 2e-6
        assert row.kept == (not row.base_failed and row.score >= -0.08)


INNER = ["key", "_key", "rules", "_rules", "_spans", "_text", "_score", "_lang_pred", "lang_pred", "score", "row_hi", "_row_hi", "row_lo", "bad_key", "doc", "best", "block0",
         "c0", "zero", "hash", "Rules_Key"]


def test_columns_called_like_inner_ones(spark, docs):
    named = docs.drop("score").withColumns({c: F.lit(f"of {c}") for c in INNER})
    benchmark = spark.createDataFrame([(1, "short text")], "item_id long, text string")
    for stage in (language.accepted, near_duplicates.first_of_each, lambda d: contamination.clean_documents(d, benchmark), secrets.redacted):
        found = stage(named)
        assert found.columns == named.columns
        rows = found.collect()
        assert rows and all(r[c] == f"of {c}" for r in rows for c in INNER)


def test_fresh_names():
    assert fresh_names(["a", "_A"], "a", "b", "a") == ["__a", "b", "___a"]

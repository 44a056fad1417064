"""Language ID, quality rules, license and secret scans against brute force."""

from __future__ import annotations

import hashlib
import re
from collections import Counter

import pytest
from conftest import PUNCTUATED, SPACED, lowered  # noqa: F401

from givingledger.llm import language, licenses, quality, secrets
from givingledger.llm.secrets import RULES, trigram_query

FOLDER = "/root/testdata/sf0.001"


def documents(spark):
    return spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text", "lang")


def all_rows(docs):
    return [(r.doc_id, r.text) for r in docs.collect()]


def bag(rows):
    return Counter(map(repr, rows))


def test_language_is_found_on_held_out_documents(spark):
    docs = documents(spark)
    known = {r.doc_id: r.lang for r in docs.collect()}
    found = language.identify(docs).collect()
    assert len(found) == len(known)
    held = [r for r in found if r.held_out]
    assert held and sum(r.lang_pred == known[r.doc_id] for r in held) >= 0.95 * len(held)
    assert all(0 <= r.score <= 1 for r in found)


def test_language_edge_cases(docs, no_docs):
    found = {(r.doc_id, r.lang_pred) for r in language.identify(docs).collect()}
    assert {(5, "und"), (6, "und"), (7, "und"), (12, "und"), (11, "fr"), (1, "en")} <= found
    assert language.identify(docs).count() == docs.count()
    assert language.identify(no_docs).collect() == []
    kept = language.accepted(docs)
    assert kept.columns == docs.columns
    assert not {5, 6, 7, 12} & {r.doc_id for r in kept.collect()}


def test_language_of_long_texts_is_scored_in_segments(spark, monkeypatch):
    docs = documents(spark).filter("lang IN ('en', 'fr')")
    (model,) = language.fit(docs)
    letters = language.letter_table()
    texts = [r.text for r in docs.limit(20).collect()]
    whole = language.score_texts([" ".join(texts)], model, letters)
    monkeypatch.setattr(language, "SEGMENT", 1000)
    assert language.score_texts([" ".join(texts)], model, letters)[1] == whole[1]


def expected_quality(text):
    words = SPACED.findall(text or "")
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    often = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if often[w] > 1 for k in range(8)}
    lines = [line for line in (text or "").split("\n") if SPACED.search(line)]
    failed = len(words) < 20 or 100 * len(covered) > 30 * len(words)
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(covered), failed)


@pytest.mark.parametrize("which", ["sample", "edge"])
def test_quality_counts(spark, docs, which):
    rows = documents(spark) if which == "sample" else docs
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    found = quality.judge(rows, labels).collect()
    expected = bag((d, *expected_quality(t)) for d, t in all_rows(rows))
    assert bag((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in found) == expected
    assert not any(r.kept and r.base_failed for r in found)


def test_quality_without_labels(spark, docs, no_docs):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    found = quality.judge(docs, none).collect()
    assert all(r.score == 0 and r.kept == (not r.base_failed) for r in found)
    assert quality.judge(no_docs, none).collect() == []


def expected_license(text):
    words = PUNCTUATED.findall(lowered(text))
    places = [(i, label) for phrase, label in licenses.PHRASES.items() for i in range(len(words)) if words[i : i + len(phrase.split())] == phrase.split()]
    starts = [p for p, _ in places]
    return len(words), len(places), min(starts, default=None), max(starts, default=None), ",".join(sorted({x for _, x in places}))


def expected_blocks(text, threshold=0.95):
    found = set()
    for line in lowered(text).split("\n"):
        words = set(PUNCTUATED.findall(line))
        for label, template in licenses.TEMPLATES.items():
            wanted = set(PUNCTUATED.findall(lowered(template)))
            if 1000 * len(words & wanted) >= round(1000 * threshold) * len(wanted):
                found.add(label)
    return found


@pytest.mark.parametrize("which", ["sample", "edge"])
def test_licenses(spark, docs, which):
    rows = documents(spark) if which == "sample" else docs
    found = licenses.scan(rows).collect()
    assert bag((r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in found) == bag(
        (d, *expected_license(t)) for d, t in all_rows(rows))
    assert bag((r.doc_id, r.labels) for r in found) == bag(
        (d, ",".join(sorted(expected_blocks(t) | set(filter(None, expected_license(t)[4].split(",")))))) for d, t in all_rows(rows))
    assert all(0 <= r.score <= 1 for r in found)


def test_licenses_broken_over_lines(spark):
    texts = ["x " * 100 + "Permission is hereby granted, free of charge, to any person obtaining a copy\nof this software and",
             "Redistribution and use in source and binary\nforms, with or without\n * modification, are permitted", "Released\n" + "x " * 100 + "under the MIT License"]
    found = licenses.scan(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    assert {r.doc_id: r.labels for r in found} == {0: "mit-text", 1: "bsd", 2: ""}


def test_licenses_with_a_word_missing(spark):
    texts = ["Permission is hereby granted, free of charge, to a person obtaining a copy of this software", "Redistribution in source and binary forms,\nwith or without modification, are permitted",
             "licensed under the GNU General Public License, version 3", "licensed under the GNU Affero General Public License 3", "subject to the terms of the Sun Public License, v. 2.0"]
    found = licenses.scan(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    assert {r.doc_id: set(filter(None, r.labels.split(","))) - {"gpl"} for r in found} == {0: {"mit-text"}, 1: {"bsd"}, 2: {"gpl-3.0"}, 3: {"agpl-3.0"}, 4: set()}


def test_licenses_of_nothing(no_docs):
    assert licenses.scan(no_docs).collect() == []


def expected_spans(text, rules=RULES):
    found = []
    for place, (kind, pattern) in enumerate(rules.items()):
        for match in re.finditer(pattern, text or "", re.ASCII):
            if secrets.valid(kind, match):
                found.append((match.start(), place, kind, match.end()))
    return sorted(found)


@pytest.mark.parametrize("which", ["sample", "edge"])
def test_secrets(spark, docs, which):
    rows = documents(spark) if which == "sample" else docs
    found = secrets.report(rows).collect()
    expected = []
    for doc_id, text in all_rows(rows):
        spans = expected_spans(text)
        joined = lambda kinds: ",".join(f"{k}:{s}:{e}" for s, _, k, e in spans if k in kinds)  # noqa: B023, E731
        base = joined(secrets.BASE)
        expected.append((doc_id, *[sum(k == b for _, _, k, _ in spans) for b in secrets.BASE], hashlib.sha256(base.encode()).hexdigest(), joined(RULES)))
    assert bag(map(tuple, found)) == bag(expected)


def test_redaction(docs, no_docs):
    clean = secrets.redacted(docs)
    assert clean.columns == docs.columns and clean.count() == docs.count()
    texts = {r.doc_id: r.text for r in clean.collect()}
    assert texts[13] == "[secret] token" and texts[14] == "[secret] and [secret]" and texts[5] is None
    assert secrets.redacted(no_docs).collect() == []


def test_redaction_takes_whole_private_keys(spark):
    begin, end = "-----BEGIN RSA PRIVATE KEY-----", "-----END RSA PRIVATE KEY-----"
    lines = ["MIIEpQIBAAKCAQEA" + c * 48 for c in "qrstuv"] + ["Zk9+/w=="]
    body = "\n".join(lines)
    texts = [
        (f"a\n{begin}\n{body}\n{end}\nb", "a\n[secret]\nb"), (f"a {begin}\n{body}\n\nplain words", "a [secret]\n\nplain words"),
        (f"k = '{begin}\\n" + "\\n".join(lines) + f"\\n{end}\\n'", "k = '[secret]\\n'"),
        (f"{begin}\nProc-Type: 4,ENCRYPTED\nDEK-Info: AES-128-CBC,0A1B\n\n{body[:-30]}", "[secret]"),
        (f"{begin}\n{body}\n{begin}\n{body}\n{end} c", "[secret]\n[secret] c"), (f"{begin} is how it begins", "[secret] is how it begins"),
        (f"{begin}\n{body}\n-----BEGIN CERTIFICATE-----", "[secret]\n-----BEGIN CERTIFICATE-----"), (f"> {begin}\n> " + "\n> ".join(lines), "> [secret]"),
        (f"{begin} {' '.join(lines)} and more", "[secret] and more"),
    ]
    docs = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(texts)], "doc_id long, text string")
    assert {r.doc_id: r.text for r in secrets.redacted(docs).collect()} == {i: t for i, (_, t) in enumerate(texts)}


def holds(query, text):
    if query is None or isinstance(query, str):
        return query is None or query in text
    return (all if query[0] == "and" else any)(holds(part, text) for part in query[1])


def test_queries_admit_every_match():
    samples = ["passwd: abcdef", "API_KEY='zzzzzz'", "apikey=1234567", "Secret = longer", "AKIA" + "A" * 16, "AIza" + "x" * 35,
               "ghp_" + "a" * 36, "xoxb-1234567890", "sk_live_" + "a" * 24, "-----BEGIN RSA PRIVATE KEY-----", "eyJ" + "a" * 8 + "." + "b" * 8 + "." + "c" * 8]
    for kind, pattern in RULES.items():
        for text in samples:
            if re.search(pattern, text, re.ASCII):
                assert holds(trigram_query(pattern), lowered(text)), (kind, text)
    assert trigram_query(RULES["hex"]) is None

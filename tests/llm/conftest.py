from __future__ import annotations

import os
import re
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent.parent
# Python workers import the operators' modules.
os.environ["PYTHONPATH"] = os.pathsep.join(filter(None, [str(ROOT), os.environ.get("PYTHONPATH")]))

PUNCTUATED = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
SPACED = re.compile(r"[^\x20\x09-\x0D]+")


def lowered(text: str | None) -> str:
    return (text or "").translate({i: i + 32 for i in range(65, 91)})


@pytest.fixture(scope="session")
def docs(spark):
    """Documents with nulls, empty and long texts, copies, repeated rows and a column whose name clashes."""
    base = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen"
    rows = [
        (1, base, "en", "a"), (2, base, "en", "a"), (3, base.upper(), "en", "b"), (4, base + " more", "en", "b"),
        (5, None, "en", "a"), (6, "", "en", None), (7, "   \n\t ", None, "a"), (8, "short text", "en", "a"),
        (9, "short text", "en", "a"), (9, "short text", "en", "a"), (10, " ".join(f"w{i}" for i in range(30000)), "en", "c"),
        (11, "été à la mer " * 40, "fr", "c"), (12, "1234 5678", "en", "c"), (13, "password = hunter22 token", "en", "c"),
        (14, "AKIA" + "Q" * 16 + " and " + "0a" * 15, "en", "c"), (None, base + " null id", "en", "c"),
        (15, "a\nAll RIGHTS reserved by us.\n\nReleased under the MIT License.\ncc\nby", "en", "c"),
        (16, "the same line here\nthe same line here\n\n\n" + "again and again " * 20, None, "c"),
    ]
    schema = "doc_id long, text string, lang string, source string, score string, spans string"
    return spark.createDataFrame([(*r, "clash", "clash") for r in rows], schema).repartition(3)


@pytest.fixture(scope="session")
def no_docs(docs):
    return docs.filter("doc_id = -1")

"""Personal data that the base patterns miss is added, and what only looks like it isn't."""

import random

import pytest
from pyspark.sql import functions as F

from areascore.llm import pii

WORDS = "the river ran along old fields where people met and talked of weather trade and long roads home".split()


def luhn_card(rng):
    d = [4, *(rng.randrange(10) for _ in range(14))]
    total = sum(sum(divmod(x * (1 + i % 2), 10)) for i, x in enumerate(reversed(d), 1))
    return "".join(map(str, d)) + str(-total % 10)


def planted(rng, kind):
    n = lambda k: "".join(str(rng.randrange(10)) for _ in range(k))
    name = rng.choice(["anna", "bo.li", "c_d"]) + n(2)
    return {
        "hidden": f"{name} (at) mail{n(1)} (dot) example (dot) com",
        "spoken": f"e-mail {name} at example{n(1)} dot org",
        "phone": f"{rng.choice(['call', 'tel.', 'phone:'])} ({rng.randrange(200, 999)}) {n(3)}-{n(4)}",
        "cards": f"{luhn_card(rng)} {luhn_card(rng)}",
        "secret": f'{rng.choice(["token", "api_key", "password"])} = "{"".join(rng.choice("0123456789abcdef") for _ in range(40))}"',
        "meeting": f"{rng.choice(WORDS)} at noon dot dot dot",
        "score": f"serial {rng.randrange(100, 999)} {n(3)} {n(4)}",
        "number": f"order {n(16)}x",
        "version": f"version {n(1)}.{n(1)}.{n(1)}.{n(1)}",
        "plain": f"keyring of {''.join(rng.choice('abcdefgh') for _ in range(30))}",
    }[kind]


GOOD = {"hidden": "email", "spoken": "email", "phone": "phone", "cards": "card", "secret": "secret"}
LOOKALIKES = ["meeting", "score", "number", "plain"]


@pytest.fixture(scope="module")
def found(spark):
    rng, rows = random.Random(7), []
    for i in range(1500):
        kind = rng.choice([*GOOD, *LOOKALIKES])
        head, tail = (" ".join(rng.choice(WORDS) for _ in range(rng.randint(3, 20))) for _ in range(2))
        item = planted(rng, kind)
        rows.append((i, f"{head} {item} {tail}", kind, len(head) + 1, len(head) + 1 + len(item)))
    docs = spark.createDataFrame(rows, "doc_id long, text string, kind string, s int, e int")
    spans = pii.report(docs).select("doc_id", "spans", "n_spans", "n_email", "n_ip", "n_card", "n_phone")
    return docs.join(spans, "doc_id").collect()


def base(row):
    return row["n_email"] + row["n_ip"] + row["n_card"] + row["n_phone"]


@pytest.mark.parametrize("kind", list(GOOD))
def test_what_the_base_misses_is_added(found, kind):
    own = [r for r in found if r["kind"] == kind]
    hit = 0
    for r in own:
        if base(r):  # sixteen digits of a token may be a card by chance
            hit += 1
            continue
        spans = [x.split(":") for x in r["spans"].split(",") if x]
        inside = [x for x in spans if x[0] == GOOD[kind] and r["s"] <= int(x[1]) and int(x[2]) <= r["e"]]
        hit += len(inside) == (2 if kind == "cards" else 1)
        assert len(spans) == r["n_spans"]
    assert hit >= 0.95 * len(own) > 50 and sum(map(base, own)) <= 0.02 * len(own)


@pytest.mark.parametrize("kind", LOOKALIKES)
def test_lookalikes_stay(found, kind):
    own = [r for r in found if r["kind"] == kind]
    assert sum(r["n_spans"] > base(r) for r in own) <= 0.02 * len(own)


def test_versions_are_the_bases_business(found):
    """The base takes any four numbers with dots; the method adds none of them."""
    model = pii.boost([], [])
    assert model.thresholds == [2.0] * len(pii.GENERATORS)


def test_given_documents_get_more_than_the_base(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    row = pii.report(docs).agg(F.sum(F.col("n_email") + F.col("n_ip") + F.col("n_card") + F.col("n_phone")), F.sum("n_spans")).first()
    assert row[1] > 1.1 * row[0]


def test_redaction_takes_the_added_spans(spark, found):
    docs = spark.createDataFrame([(r["doc_id"], r["text"]) for r in found], "doc_id long, text string")
    clean = {r["doc_id"]: r["text"] for r in pii.redact(docs).collect()}
    own = [r for r in found if r["kind"] == "secret"]
    assert sum("[secret]" in clean[r["doc_id"]] for r in own) >= 0.95 * len(own)

"""Personal data against Python's own regular expressions."""

import hashlib
import random
import re

from pyspark.sql import functions as F

from tests.llm.conftest import SF
from tidemark.llm import pii, queries

BASE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(v):
    d = [int(c) for c in v if c.isdigit()][::-1]
    return sum(x if i % 2 == 0 else sum(divmod(2 * x, 10)) for i, x in enumerate(d)) % 10 == 0


VALID = {
    "email": lambda v: True,
    "ip": lambda v: all(int(p) <= 255 for p in v.split(".")),
    "card": lambda v: 12 <= sum(c.isdigit() for c in v) <= 19 and luhn(v),
    "phone": lambda v: 9 <= sum(c.isdigit() for c in v) <= 15,
}


def base_spans(text):
    found = [(m.start(), list(BASE).index(k), k, m.end()) for k, p in BASE.items() for m in re.finditer(p, text or "") if VALID[k](m.group())]
    return [f"{k}:{a}:{b}" for a, _, k, b in sorted(found)]


def test_pii_query(spark, documents):
    got = {r.doc_id: r for r in queries.op8_pii(spark, SF).collect()}
    for doc_id, text in documents.select("doc_id", "text").collect():
        want, r = base_spans(text), got.pop(doc_id)
        assert r.base_sha256 == hashlib.sha256(",".join(want).encode()).hexdigest(), (want, r.spans)
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(sum(s.startswith(k) for s in want) for k in BASE)
        assert [s for s in r.spans.split(",") if s.split(":")[0] in BASE] == want
        assert len(r.scores.split(",")) == len(r.spans.split(","))
    assert not got


def test_base_spans_of_awkward_texts(spark):
    rng = random.Random(4)
    parts = ["a@b.c", "@", ".", "1", "255", "256", "1.2.3.4", "+1", " ", "-", "4111 1111 1111 1111", "4111111111111111", "(555) 123-4567", "é", "\U0001f600", "x_y%z@d-e.f", "00", "\n", "e.f", "+", "0000001"]
    made = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 14))) for _ in range(3000)]
    made += ["a" * 50000, "1" * 50000, "1 " * 20000, "a@" * 20000, "1." * 20000, "+1" + "(" * 40000, "a.b@c.d " * 300, None, ""]
    df = spark.createDataFrame(list(enumerate(made)), "doc_id int, text string").repartition(8)
    for r in pii.find(df).select("doc_id", pii.listed(pii.of_kinds("spans", *pii.BASE)).alias("s")).collect():
        assert r.s == ",".join(base_spans(made[r.doc_id])), made[r.doc_id][:200]


def test_scores_context_and_redaction(spark):
    good = "GB82 WEST 1234 5698 7654 32"
    texts = [f"my iban is {good}, thanks", "id DE89370400440532013000 x", "id DE89370400440532013001 x", "call +1 (555) 123-4567 or mail 4111111111111111@x.org"]
    df = spark.createDataFrame([(t, "clash") for t in texts], "text string, spans string")
    got = pii.find(df)
    of = {r.text: r for r in got.withColumn("out", pii.redacted(got["text"], got["spans"])).collect()}
    assert [(s.kind, s.score, s.value) for s in of[texts[0]].spans] == [("iban", 0.95, good)]
    assert [(s.kind, s.score) for s in of[texts[1]].spans] == [("iban", 0.7)] and not of[texts[2]].spans
    assert of[texts[0]].out == "my iban is [IBAN], thanks" and of[texts[2]].out == texts[2]
    assert of[texts[3]].out == "call [PHONE] or mail [EMAIL]"
    assert pii.find(df.where("false")).count() == 0


def test_a_context_word_decides(spark):
    pairs = {
        "my ssn 219-09-9999 here": ["ssn:7:18"], "part no 219-09-9999 here": [], "my ssn 666-09-9999 here": [],
        "please call 555-123-4567 now": ["local:12:24"], "item 555-123-4567 now": [], "a television 555-123-4567": [], "tel 555-123-4567": ["local:4:16"],
        "555-123-4567" + " " * 39 + "fax": [], "555-123-4567" + " " * 37 + "fax": ["local:0:12"],
    }
    got = pii.find(spark.createDataFrame([(t,) for t in pairs], "text string")).select("text", pii.listed(F.col("spans")).alias("s")).collect()
    assert {r.text: r.s for r in got} == {t: ",".join(w) for t, w in pairs.items()}


def near(text, a, b):
    return text[max(0, a - pii.NEAR) : a] + "\n" + text[b : b + pii.NEAR]


def test_scores_of_every_span(spark):
    """Scores of neighbouring matches against the code points before and after each."""
    rng = random.Random(8)
    parts = ["ip", "server", " ", "1.2.3.4", "ipsum ", "x", "host ", "+1 555 1234 567", " é", "a@b.cd", "mail ", "IP:", "\n"]
    made = ["".join(rng.choice(parts) for _ in range(rng.randint(1, 40))) for _ in range(400)]
    for r in pii.find(spark.createDataFrame([(t,) for t in made], "text string")).collect():
        for s in r.spans:
            words = "|".join(pii.CONTEXT[s.kind])
            raised = re.search(rf"(?<![a-z])(?:{words})s?(?![a-z])", near(r.text, s.start, s.end).lower())
            assert s.value == r.text[s.start : s.end] and s.score == round(pii.SCORES[s.kind] + (pii.RAISED if raised else 0), 2)


def redacted(text, spans):
    out, at = "", 0
    for s in spans:
        if s.start >= at:
            out += text[at : s.start] + f"[{s.kind.upper()}]"
        at = max(at, s.end)
    return out + text[at:]


def test_many_spans_in_one_text(spark):
    """Work that grew with the square of the spans of a text would not end here."""
    text = " ".join(f"u{i}@example.org from 10.0.{i % 256}.7 é" for i in range(20000))
    got = pii.find(spark.createDataFrame([(text,)], "text string"))
    (r,) = got.withColumn("out", pii.redacted(got["text"], got["spans"])).collect()
    assert len(r.spans) == 40000 and r.out == redacted(text, r.spans)

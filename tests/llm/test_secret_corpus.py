import random
import string

from perilgrid.llm.secret_scan import secret_scan

WORDS = "international readable development application configuration administrator community".split()


def test_verdict_does_not_depend_on_the_document(docs):
    rng = random.Random(5)
    secrets = ["".join(rng.choices(string.ascii_letters + string.digits, k=rng.choice([32, 40, 64]))) for _ in range(60)]
    plain = ["-".join(rng.choices(WORDS, k=4)) for _ in range(400)]
    rows = [(i, f"value {s} end") for i, s in enumerate(secrets)]
    rows += [(100 + i, f"value {s} " + " ".join(plain)) for i, s in enumerate(secrets)]
    begin = len("value ")
    got = {r.doc_id: f"random:{begin}:" in r.spans for r in secret_scan(docs(rows)).collect()}
    assert [got[i] for i in range(60)] == [got[100 + i] for i in range(60)]
    assert any(got.values())

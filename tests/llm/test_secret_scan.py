"""The forest on held-out findings whose labels come from how they were made, not from the features."""

import random
import string

from pyspark.sql import functions as F

from tidemark.llm import secret_scan

MIXED = string.ascii_letters + string.digits
HEX = "0123456789abcdef"


def findings(n=1200):
    """(doc_id, text, source, truth): one candidate a document, secret or look-alike."""
    draw = random.Random(11)

    def of(letters, size):
        return "".join(draw.choice(letters) for _ in range(size))

    rows = []
    for i in range(n):
        kind = i % 8
        key, digest = of(MIXED, draw.randint(20, 40)) + "7", of(HEX, draw.choice((32, 40, 64))) + "0"
        folder = draw.choice(("srv/app", "deploy/prod", "web/api/core"))
        text, source, truth = (
            (f"the service starts with api_key = {key} and logs", f"{folder}/settings.yaml", 1),
            (f"export TOKEN={key} before the job", f"{folder}/run.sh", 1),
            (f"old note: the login is hidden here {key} do not share", f"{folder}/notes.txt", 1),
            (f"password: '{key}' for the database", f"{folder}/main.conf", 1),
            (f"fixed by commit {digest} last week", f"{folder}/CHANGES.md", 0),
            (f"sha256 checksum {digest} of the file", f"{folder}/files.lock", 0),
            (f"set api_key = your_example_{of(string.ascii_lowercase, 8)}_1 first", "docs/examples/start.md", 0),
            (f"token = {key} in a unit test", "lib/tests/fixtures/login.json", 0),
        )[kind]
        rows.append((i, text, source, truth))
    return rows


def test_held_out_findings(spark):
    docs = spark.createDataFrame(findings(), "doc_id long, text string, source string, truth int").cache()
    held_out = F.pmod(F.xxhash64("doc_id"), F.lit(3)) == 0
    truth = F.create_map(*[F.lit(x) for r in findings() for x in (r[0], r[3])])
    label = F.when(~held_out, F.element_at(truth, F.col("doc_id")))
    found = secret_scan.secret_scan(docs, label).join(docs.select("doc_id", "truth"), "doc_id").filter(held_out).collect()
    # One verdict a document: a text is flagged if any candidate in it is.
    flagged = {r.doc_id for r in found if r.is_secret}
    secret = {r[0] for r in findings() if r[3]} & {r.doc_id for r in docs.filter(held_out).collect()}
    hits = len(flagged & secret)
    assert hits >= 0.9 * len(flagged) and hits >= 0.9 * len(secret) and len(secret) > 100


def test_path_and_neighbour_features(spark):
    rows = [
        (1, "api_key = aB3dE5gH7jK9mN1pQ3 checksum", "a/tests/b.yaml"),
        (2, "plain aB3dE5gH7jK9mN1pQ3", None),
        (3, "TOKEN=your_example_value_123456", "contest/latest.txt"),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    ready = secret_scan.with_features(secret_scan.candidates(docs), secret_scan.dictionary(docs)).collect()
    names = ("f_near_credential", "f_near_digest", "f_near_placeholder", "f_path_depth", "f_path_sample", "f_path_settings")
    found = {r.doc_id: tuple(r[n] for n in names) for r in ready}
    assert found[1] == (1, 1, 0, 2, 1, 1)
    assert found[2] == (0, 0, 0, 0, 0, 0)
    assert found[3] == (1, 0, 1, 1, 0, 0)

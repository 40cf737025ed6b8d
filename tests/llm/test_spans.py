"""Personal data and secrets against plain regular expressions."""

from dataclasses import replace

import pytest
from brute import pii as brute_pii
from brute import secrets as brute_secrets
from conftest_rows import PII_TEXTS, SECRET_TEXTS

from talkgrain.llm.pii import find_pii, pii_digest
from talkgrain.llm.secrets import RULES, find_secrets, redacted, scan_unseen, secrets_digest

PII_COLUMNS = ["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256"]
SECRET_COLUMNS = ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256"]


def frame(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")


def test_pii_on_documents(documents, texts, same):
    same(pii_digest(find_pii(documents)), PII_COLUMNS, brute_pii(texts))


def test_pii_on_hand_made_texts(spark, same):
    result = pii_digest(find_pii(frame(spark, PII_TEXTS)))
    same(result, PII_COLUMNS, brute_pii(enumerate(PII_TEXTS)))


def test_pii_on_odd_rows(odd, same, spark):
    from conftest import ODD

    same(pii_digest(find_pii(odd)), PII_COLUMNS, brute_pii(ODD))
    assert pii_digest(find_pii(odd.limit(0))).collect() == []


def test_added_kinds(spark):
    texts = [
        "IBAN GB82 WEST 1234 5698 7654 32",
        "bank GB82WEST12345698765431 wrong digits",
        "ssn 123-45-6789",
        "the number 123-45-6789",
        "call 212-555-0100",
        "part 212-555-0100",
    ]
    found = find_pii(frame(spark, texts)).orderBy("doc_id").collect()
    kinds = [[s["kind"] for s in row["spans"]] for row in found]
    assert kinds == [["iban"], [], ["ssn"], [], ["local_phone"], []]
    assert found[0]["spans"][0]["end"] == len(texts[0])


def test_account_numbers_end_where_they_do(spark):
    numbers = ["DE89 3704 0044 0532 0130 00", "GB82WEST12345698765432", "NO93 8601 1117 947"]
    after = [" BIC COBADEFF", " Please pay", " On Monday", " 20 EUR", " 1234 5678", ". And", ""]
    texts = [f"pay {n}{a}" for n in numbers for a in after]
    texts += ["pay GB82WEST12345698765432X", "pay DE89 3704 0044 0532 0130 01 BIC"]
    rows = find_pii(frame(spark, texts)).orderBy("doc_id").collect()
    got = [[(s["start"], s["end"]) for s in r["spans"] if s["kind"] == "iban"] for r in rows]
    assert got == [[(4, 4 + len(n))] for n in numbers for _ in after] + [[], []]


def test_context_raises_the_score(spark):
    rows = find_pii(frame(spark, ["x 8.8.8.8", "server 8.8.8.8"])).orderBy("doc_id").collect()
    plain, near = (row["spans"][0]["score"] for row in rows)
    assert near > plain


def test_secrets_on_documents(documents, texts, same, tmp_path):
    result = secrets_digest(find_secrets(documents, str(tmp_path / "ledger")))
    same(result, SECRET_COLUMNS, brute_secrets(texts))


@pytest.mark.parametrize("again", [False, True])
def test_secrets_on_hand_made_texts(spark, same, tmp_path, again):
    docs, ledger = frame(spark, SECRET_TEXTS), str(tmp_path / "ledger")
    if again:
        find_secrets(docs.limit(3), ledger).collect()
    result = secrets_digest(find_secrets(docs, ledger))
    same(result, SECRET_COLUMNS, brute_secrets(enumerate(SECRET_TEXTS)))


def test_secrets_on_odd_rows(odd, same, tmp_path):
    from conftest import ODD

    result = secrets_digest(find_secrets(odd, str(tmp_path / "a")))
    same(result, SECRET_COLUMNS, brute_secrets(ODD))
    assert find_secrets(odd.limit(0), str(tmp_path / "b")).collect() == []


def test_ledger_scans_only_unseen_pairs(spark, tmp_path):
    ledger = str(tmp_path / "ledger")
    docs = frame(spark, ["one", "two", "one"])
    assert scan_unseen(docs, ledger).count() == 2 * len(RULES)
    assert scan_unseen(docs, ledger).count() == 2 * len(RULES)
    assert scan_unseen(frame(spark, ["two", "three"]), ledger).count() == 3 * len(RULES)
    from dataclasses import replace

    newer = (replace(RULES[0], version=2), *RULES[1:])
    assert scan_unseen(docs, ledger, rules=newer).count() == 3 * len(RULES) + 2


def test_redaction(spark, tmp_path):
    key = "AKIA" + "A" * 16
    texts = ["", None, "clean", key, f"a {key} b {key}", 'token = "' + "0f" * 20 + '" end']
    docs = frame(spark, texts)
    found = find_secrets(docs, str(tmp_path / "ledger")).drop("blob")
    rows = docs.join(found, "doc_id").orderBy("doc_id")
    got = [r[0] for r in rows.select(redacted(docs.text, found.spans)).collect()]
    assert got == ["", None, "clean", "[secret]", "a [secret] b [secret]", '[secret]" end']


def test_the_query_scans_only_what_its_ledger_lacks(spark, rows_of, tmp_path, monkeypatch):
    """A second run adds no row to a lasting ledger; a rule of a new version is scanned alone."""
    from talkgrain.llm import queries, secrets

    folder = "/root/testdata/sf0.001"
    ledger = str(tmp_path / "ledger")

    def rows():
        return spark.read.schema(secrets.LEDGER).parquet(ledger)

    first = rows_of(queries.op7_secrets(spark, folder, ledger))
    blobs = spark.read.parquet(f"{folder}/documents.parquet").select("text").distinct().count()
    assert rows().count() == blobs * len(secrets.RULES)
    assert rows_of(queries.op7_secrets(spark, folder, ledger)) == first
    assert rows().count() == blobs * len(secrets.RULES)
    raised = tuple(replace(r, version=2) if r.name == "hex" else r for r in secrets.RULES)
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    again = secrets.secrets_digest(secrets.find_secrets(docs, ledger, rules=raised), raised)
    assert rows_of(again) == first
    added = rows().where("version = 2")
    assert added.count() == blobs and rows().count() == blobs * (len(secrets.RULES) + 1)
    assert {r[0] for r in added.select("rule").distinct().collect()} == {"hex"}


def test_context_words_raise_the_score_of_any_span(spark):
    docs = frame(spark, ["write an e-mail to a@b.cd", "a@b.cd", "visa 4111111111111111 and a@b.cd", "nothing"])
    rows = pii_digest(find_pii(docs)).orderBy("doc_id").collect()
    scores = [[int(x) for x in r["scores"].split(",") if x] for r in rows]
    assert [len(s) for s in scores] == [1, 1, 2, 0]
    assert scores[0][0] > scores[1][0] == 70
    # By kind: the e-mail address, then the card, which stands beside its word.
    assert scores[2][0] == 70 and scores[2][1] > 60

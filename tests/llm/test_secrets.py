import random
import re

from pyspark.sql import functions as F

from clearledger.llm import secrets
from clearledger.llm.secrets import Rule, redact, scan

ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)


def base(text):
    """As the rules are stated: match, then drop what is too short."""
    found = [("assign", *m.span()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    found += [("access", *m.span()) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    found += [("hex", *m.span()) for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(found, key=lambda s: (s[1], ["assign", "access", "hex"].index(s[0])))


PARTS = [
    "token=", "Token : '", 'api_KEY="', "apikey=", "passwd:", "ſecret=", "abc", "a1B2c3D4e5", "deadbeef" * 3, "deadbeef" * 2, "AKIA", "ABCDEFGH12345678",
    " ", "\n", "🙂", "é", "token=token:abcdefgh", "x" * 5, "AKIAAKIA" + "Z" * 12, "Bearer " + "t" * 25, "https://u:p@h", "-----BEGIN RSA PRIVATE KEY-----\nMII=\n-----END RSA PRIVATE KEY-----",
]


def texts(seed, n):
    rng = random.Random(seed)
    return ["".join(rng.choices(PARTS, k=rng.randint(0, 12))) for _ in range(n)]


def test_base_spans_against_the_plain_rules(spark, docs):
    rows = list(enumerate(texts(16, 400) * 2))
    got = scan(spark, docs(rows)).collect()
    assert len(got) == len(rows)
    for r in got:
        assert [tuple(s) for s in r.spans if s.kind in ("assign", "access", "hex")] == base(rows[r.doc_id][1])
    kinds = {s.kind for r in got for s in r.spans}
    assert kinds == {r.kind for r in secrets.RULES} - {"jwt"}


def test_odd_rows(spark, odd, nothing):
    got = scan(spark, odd).collect()
    assert sorted(str(r.doc_id) for r in got) == sorted(str(r.doc_id) for r in odd.collect())
    assert all(r.spans == [] for r in got)
    assert scan(spark, nothing).count() == 0


def test_ledger_scans_only_unseen_pairs(spark, docs, tmp_path):
    ledger, one = str(tmp_path / "ledger"), [secrets.RULES[0]]
    pairs = lambda: sorted((r.blob, tuple(sorted(r.rules))) for r in spark.read.parquet(ledger).collect())
    first = docs([(1, "token=abcdef1"), (2, "plain"), (3, "plain"), (None, "plain")])
    scan(spark, first, ledger, one).collect()
    assert [len(p[1]) for p in pairs()] == [1, 1]
    scan(spark, first, ledger, one).collect()
    assert len(pairs()) == 2  # nothing new
    found = {r.doc_id: [s.kind for s in r.spans] for r in scan(spark, docs([(9, "plain"), (8, "new token=abcdef1"), (7, "token=abcdef1")]), ledger, one).collect()}
    assert found == {9: [], 8: ["assign"], 7: ["assign"]}
    assert len(pairs()) == 3
    newer = Rule("assign", 2, lambda t: iter([(0, 1)] if t else []))
    found = {r.doc_id: [tuple(s) for s in r.spans] for r in scan(spark, first.filter("doc_id = 1"), ledger, [newer, secrets.RULES[2]]).collect()}
    assert len(pairs()) == 4 and pairs().count((pairs()[0][0], ("assign@1",))) <= 1
    assert ("assign", 0, 1) in found[1]


def test_redaction(spark, docs):
    rows = [(1, "key token=abcdef1 and AKIA" + "Q" * 16 + " end"), (2, "nothing"), (3, None), (4, "token=" + "ab12" * 8), (5, "é🙂 secret: zzzzzz\n")]
    got = {r.doc_id: r for r in redact(spark, docs(rows)).collect()}
    assert {i: r.text for i, r in got.items()} == {1: "key [SECRET] and [SECRET] end", 2: "nothing", 3: None, 4: "[SECRET]", 5: "é🙂 [SECRET]\n"}
    assert all(r.text is None or r.n_chars == len(r.text) for r in got.values())
    assert redact(spark, docs(rows).filter(F.lit(False))).count() == 0

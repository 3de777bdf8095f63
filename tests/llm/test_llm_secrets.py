"""Secret scans: base patterns against a hand-written scanner, the lexer against marked snippets."""

from __future__ import annotations

import hashlib
import random
import time

import pytest

from tidegate.llm import secret_scan
from tidegate.llm.queries import QUERIES

VALUE = set("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_.=-")
NAMES = ["password", "passwd", "secret", "token", "api_key", "apikey"]


def _fold(c):
    return c.lower() if "A" <= c <= "Z" else c


def _assign_at(text, i):
    """End of the value and its length, for an assignment that starts at ``i``."""
    for name in NAMES:
        if [_fold(c) for c in text[i : i + len(name)]] != list(name):
            continue
        at = i + len(name)
        at += text[at : at + 1] in ("'", '"')
        while text[at : at + 1] == " ":
            at += 1
        if text[at : at + 1] not in ("=", ":"):
            continue
        at += 1
        while text[at : at + 1] == " ":
            at += 1
        at += text[at : at + 1] in ("'", '"')
        end = at
        while text[end : end + 1] in VALUE:
            end += 1
        if end > at:
            return end, end - at
    return None


def _run_at(text, i, head, chars):
    if not text.startswith(head, i):
        return None
    end = i + len(head)
    while end < len(text) and text[end] in chars:
        end += 1
    return (end, end - i) if end > i + len(head) else None


def brute_base(text):
    text = text or ""
    out = []
    for order, (kind, least, at) in enumerate([
        ("assign", 6, _assign_at),
        ("access", 20, lambda t, i: _run_at(t, i, "AKIA", "ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789")),
        ("hex", 24, lambda t, i: _run_at(t, i, "", "0123456789abcdef")),
    ]):
        i = 0
        while i < len(text):
            match = at(text, i)
            if match is None:
                i += 1
                continue
            if match[1] >= least:
                out.append((i, order, kind, match[0]))
            i = match[0]
    return [f"{kind}:{start}:{end}" for start, _, kind, end in sorted(out)]


def test_query_matches_brute_force(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    df = QUERIES["op13_secret_scan"](spark, sf_dir)
    assert df.dtypes == [
        ("doc_id", "bigint"), ("n_assign", "bigint"), ("n_access", "bigint"), ("n_hex", "bigint"),
        ("base_sha256", "string"), ("spans", "string"),
    ]
    got = {r["doc_id"]: r for r in df.collect()}
    assert len(got) == len(docs)
    for doc_id, text in docs:
        base, row = brute_base(text), got[doc_id]
        assert row["base_sha256"] == hashlib.sha256(",".join(base).encode()).hexdigest()
        for kind in ("assign", "access", "hex"):
            assert row[f"n_{kind}"] == sum(b.startswith(kind) for b in base)
        spans = row["spans"].split(",") if row["spans"] else []
        assert [s for s in spans if not s.startswith("literal:")] == base


def test_base_patterns_of_random_texts():
    rng = random.Random(4)
    pieces = [
        *NAMES, "PassWord", "pa\u017f\u017fword", "to\u212aen", "AKIA", "AKIA" + "Z" * 16, "AKIAABCDEFGHIJKLMNO", "deadbeef" * 3,
        "0123456789abcdef0123456", "=", ":", "==", " ", "  ", "\t", "'", '"', "abc.def/1", "x", "\n", "é", "😀", ",", "abcdef",
    ]
    for _ in range(3000):
        text = "".join(rng.choices(pieces, k=rng.randrange(1, 14)))
        found = [f"{k}:{s}:{e}" for s, k, e, _, _ in secret_scan.find(text) if k != "literal"]
        assert found == brute_base(text), text


#: Literals in brackets are expected.
SNIPPETS = [
    'db = "[s3cr]"\nconn.pwd = db + "[etPass99]"\n',
    'part = "[Zx81kQ]"\nrest = "[77aB_9]"\nother = "aaB1_9c"\nclient.credentials = part + rest\n',
    '{"name": "DB_PASSPHRASE", "value": "[Tr0ub4dor&3x]", "user": "Zz9kkLw0"}',
    '<add key="MasterPassphrase" value="[qW3rty!9zz]" /><add key="Title" value="qW3rty!9zz" />',
    "<clientPassphrase>[hj7*Ty2_w]</clientPassphrase><title>hj7*Ty2_w</title>",
    "private_key: |\n  [-----BEGIN KEY-----\n  abcDEF123\n  zzz9]\nother: 1\n",
    "os.environ['AWS_PWD'] = '[Qm9vIQ11z]'",
    'setenv("SIGNING_KEY", "[k9JH-22ab]")\nsetenv("HOME", "k9JH-22ab")',
    "pwd: [hunter2x9]  # the dog\nuser: hunter2x9\n",
    'const passphrase: string = "[correct-Horse-7]";',
    '$dbPwd = "[abc]" . "[def123]" . "[ghi]";',
    'X="[aB3dE5gH]"\nexport DB_PWD=$X\n',
    'pwd = decode("[YWJjZGVmZ2hpag9]")',
    'pwd = f(g("[Ab12cd]"), h("[ZZ99yy]")) + "[q1z]"',
    "conn = 'Server=db;Pwd=[abc123XY];'",
    'a = "[Zz9Kk2]"\n' + "a = a + a\n" * 50 + "pwd = a\n",
    'key = "[first1A9z]"\nbearer = key\nkey = "second2B8y"\n',
    'pwd = "[aQ1]"\npwd += "[bW2xY7]"\n',
]
CLEAN = [
    "The secret: it's a word and token : none. See http://example.com/a?b=c at 12:30, ratio 3:4.",
    "token_count = 123456\npwd_hint = 'my dog 123abc'\nauth_url = 'https://a.b/c?d=9Xz81'\n",
    'passphrase = "${VAULT}"\npassphrase = "changeme"\npwd = "<your pwd>"\npwd = None\npwd: string\n',
    'name = "Zx81kQ77aB_9"\nvalue = "Zx81kQ77aB_9"\n', "pwd = get_pwd(user)\n", "pwd =", "pwd = '", "", "\u00e9" * 50,
]


@pytest.mark.parametrize("snippet", SNIPPETS)
def test_literals(snippet):
    marked = any(f"{c}[" in snippet or f"[{c}" in snippet for c in "'\"") and "environ" in snippet
    snippet = snippet.replace("environ['AWS_PWD']", "environ<<'AWS_PWD'>>") if marked else snippet
    text, want = "", []
    for i, part in enumerate(snippet.replace("]", "[").split("[")):
        part = part.replace("<<", "[").replace(">>", "]")
        if i % 2:
            want.append((len(text), len(text) + len(part)))
        text += part
    assert [(s, e) for s, k, e, _, _ in secret_scan.find(text) if k == "literal"] == want


@pytest.mark.parametrize("text", CLEAN)
def test_clean_texts_have_no_literals(text):
    assert not [f for f in secret_scan.find(text) if f[1] == "literal"]


def test_base_spans_are_not_reported_twice():
    text = 'token = "abcDEF123456"\nx = "aB3dE5gH"\npwd = x'
    assert [f[1] for f in secret_scan.find(text)] == ["assign", "literal"]


@pytest.mark.parametrize("piece", [
    "a", 'a="', "'", "a-", "<a>", "x: |\n", "a=b+", "f(", "a=f(", '"a":', "token=", '"""', 'a="""', "($", "('a',",
    "a = f(x, \n", "<a b", "a= ", "a=`", "a='x' ", "a=/", 'a="x" + ', "x='b=\"\" ' ", "a=b.", "a:b", "x:[", "0a", "AKIA",
])
def test_time_follows_the_length(piece):
    start = time.process_time()
    secret_scan.find(piece * (300_000 // len(piece)))
    assert time.process_time() - start < 30  # a quadratic search takes many minutes


def test_odd_rows(spark):
    text = 'pwd = "Zz81kkQ0"'
    rows = [(1, None, "x", 1), (2, "", "x", 1), (None, text, "x", 1), (4, text, "x", 1), (4, text, "x", 1)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, findings string, id int")
    out = secret_scan.scan(df)
    assert out.columns == ["doc_id", "findings"]
    got = [(r["doc_id"], [tuple(f)[:4] for f in r["findings"]]) for r in out.collect()]
    one = [("literal", 7, 15, "pwd")]
    assert got == [(1, []), (2, []), (None, one), (4, one), (4, one)]
    assert secret_scan.scan(df.limit(0)).count() == 0

"""Private keys of any length, closed, cut off, or with line ends written out; rows of the mix that are equal but for their source."""

import collections
import hashlib

import pytest

from marketlake.llm import mixing, secrets


def lines(n):
    return [hashlib.sha512(str(i).encode()).hexdigest()[:64] for i in range(n)]


HEAD, END = "-----BEGIN RSA PRIVATE KEY-----", "-----END RSA PRIVATE KEY-----"
BODY = "\n".join(lines(700))
CASES = [
    (f"see\n{HEAD}\n{BODY}\n{END}\nafter it", f"{HEAD}\n{BODY}\n{END}"),
    (f"cut {HEAD}\n{BODY}\nand so on", f"{HEAD}\n{BODY}"),
    (f"dashes {HEAD}\n{'--a' * 300}\n{END} x", f"{HEAD}\n{'--a' * 300}\n{END}"),
    (f'"{HEAD}' + "\\n" + "\\n".join(lines(30)) + "\\r\\nshort one", HEAD + "\\n" + "\\n".join(lines(30))),
    (f"{HEAD}\r\n{lines(1)[0]}\r\n\r\n{lines(2)[1]}\r\n", f"{HEAD}\r\n{lines(1)[0]}\r\n\r\n{lines(2)[1]}"),
    (f"no key {HEAD} was shown", None),
    (f"two {HEAD}\n{BODY[:200]}\n{END} and {HEAD}\n{BODY[300:600]}\n{END}.", None),
]


def test_private_keys_go_whole(spark):
    rows = [(i, t, "a") for i, (t, _) in enumerate(CASES)] + [(100 + i, f"harmless words number {i} here", "a") for i in range(20)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = {r.doc_id: r.text for r in secrets.redact(docs).collect()}
    for i, (text, key) in enumerate(CASES[:5]):
        assert got[i] == text.replace(key, "[secret]"), i
    assert got[5] == CASES[5][0]
    assert got[6] == "two [secret] and [secret]."


def test_place_of_a_key(spark):
    text = f"one two {HEAD}\n{BODY}\n{END} three"
    docs = spark.createDataFrame([(1, text, None)], "doc_id long, text string, source string")
    (r,) = secrets.candidates(docs).where("value like '-----BEGIN%'").collect()
    assert (r.word, r.after, r.value) == (2, "three", f"{HEAD}\n{BODY}\n{END}")
    assert secrets.candidates(docs).count() == 1  # its lines are no candidates of their own


@pytest.mark.parametrize("n", [1, 7])
def test_equal_rows_of_two_sources_follow_their_own_source(spark, n):
    rows = [(i, f"w{i} " * 10, "x") for i in range(40)] + [(i, f"w{i} " * 10, s) for i in (100, 101) for s in ("x", "y", None) for _ in range(n)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(3)
    want = collections.Counter()
    for r in mixing.plan(docs, split=False).collect():
        want[r.doc_id, r.source] += r.times
    got = collections.Counter((r.doc_id, r.source) for r in mixing.mixed(docs).collect())
    assert got == +want

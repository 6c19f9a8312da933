"""Secrets in forms that the forest was not taught, and what only looks like one; candidates against a plain scan of words."""

import random
import re

from marketlake.llm import secrets

B64 = "dXNlcjpvcGVuc2VzYW1lMTIz"
AWS = "kTq7Vb2nYx0LmRz9WcPd4HsJgF6uEa8oNi3KvX1B"
LEFT = [
    ("dsn postgres://admin:s3cr3tPw9@db.local/app in use", "s3cr3tPw9"),
    ("run mysql -u root -pS3cretPass99 shop", "S3cretPass99"),
    (f"Authorization: Basic {B64} was sent", B64),
    (f"the AWS secret {AWS} leaked", AWS),
    ("key sk-proj-" + "aB3dE5fG7hJ9kL1mN2pQ4rS6tU8vW0xY" + " leaked", "sk-proj-aB3dE5fG7hJ9kL1mN2pQ4rS6tU8vW0xY"),
    ("password = correcthorsebattery for all", "correcthorsebattery"),
    ("the password was hunter2hunter2 until May", "hunter2hunter2"),
    ("password: abc12 and more", "abc12"),
    ("pwd=a1b2c here", "a1b2c"),
]
CLEAN = [
    "see https://example.com:8080/path and ftp://host/file for more", "clone ssh://git@code.example.com:2222/group/project now", "gcc -pedantic -pipe main.c", "the token was expired by then", "a password is required here",
    "use the --password option to log in", "max tokens: 4096 a call", "auth: none", "the secret of the garden was found", "password: {{ vault }} in the template", "redis://user:password@localhost/0 is the default", "secret: true",
]


def frame(spark, texts):
    plain = [f"harmless words number {i} stand here between the others" for i in range(40)]
    return spark.createDataFrame([(i, t, "web") for i, t in enumerate([*texts, *plain])], "doc_id long, text string, source string")


def test_forms_go_and_clean_texts_stay(spark):
    texts = [t for t, _ in LEFT] + CLEAN
    got = {r.doc_id: r.text for r in secrets.redact(frame(spark, texts)).collect()}
    want = [t.replace(v, "[secret]") for t, v in LEFT] + CLEAN
    wrong = [(got[i], w) for i, w in enumerate(want) if got[i] != w]
    assert not wrong, wrong


def held_out(n=240, seed=11):
    """Findings in other wordings than `secrets.WRITTEN` and `secrets.HARMLESS`, some close to theirs (bearer, `-p`, "is"): (text, value, is a secret)."""
    r = random.Random(seed)
    abc = "abcdefghijklmnopqrstuvwxyz"
    key = lambda k: "".join(r.choice(abc + abc.upper() + "0123456789") for _ in range(k - 2)) + r.choice("0123456789") + r.choice(abc)
    some = lambda: r.choice(["river", "window", "orange", "mountain", "garden", "silver"])
    yes = [
        lambda v: f"<property name='db.passwd' value=... passwd=\"{v}\"/>", lambda v: f"$env:API_KEY = '{v}'", lambda v: f"mongodb+srv://svc:{v}@cluster0.example.net/db", lambda v: f"curl -H 'Authorization: Bearer {v}' https://api.example.com",
        lambda v: f"set -x PGPASSWORD={v} psql", lambda v: f"my new password is {v}", lambda v: f"SECRET_KEY: '{v}'", lambda v: f"config.auth_token => \"{v}\"", lambda v: f"mysqldump -pX{v} all",
    ]
    no = [
        lambda v: f"blob {r.getrandbits(160):040x} in the tree", lambda v: f"order {r.randrange(10**15, 10**16)} was shipped", lambda v: f"mailto or https://{some()}.example.org/{some()}/{r.randrange(10**6)}", lambda v: f"password: {some()} and so on",
        lambda v: f"GET /{some()}/{some()}-{r.randrange(10**7)}.html", lambda v: 'token = os.environ["TOKEN_V2"]', lambda v: f"secret = {some()}", lambda v: f"sha256:{r.getrandbits(256):064x}", lambda v: "api_key = <your-key-here-1>",
    ]
    out = []
    for i in range(n):
        v = key(r.choice([8, 10, 16, 24, 32]))
        good = i % 2 == 0
        text = r.choice(yes if good else no)(v)
        out.append((text, "X" + v if good and "-pX" in text else v, good))
    return out


def test_precision_and_recall_on_forms_not_taught(spark):
    rows = held_out()
    found = {}
    for r in secrets.scan(frame(spark, [t for t, _, _ in rows])).where("is_secret").collect():
        found.setdefault(r.doc_id, set()).add(r.value)
    caught = sum(good and v in found.get(i, ()) for i, (_, v, good) in enumerate(rows))
    false = [(t, found[i]) for i, (t, _, good) in enumerate(rows) if not good and i in found]
    good = sum(g for _, _, g in rows)
    missed = [t for i, (t, v, g) in enumerate(rows) if g and v not in found.get(i, ())]
    print("recall", caught / good, "precision", caught / max(1, caught + len(false)), false[:5], missed[:9])
    assert caught >= 0.9 * good and caught >= 0.9 * (caught + len(false)), (caught, good, false[:9], missed[:9])


NAME = r"(?:passw(?:or)?d|passwd|pwd|secret(?:_?key)?|token|api_?key|access_?key|auth|credential|private[_\- ]?key)"


def plain_candidates(text):
    """(word's place, value) by a walk over the words, for texts without private keys and web tokens."""
    words, out = re.split(r"[ \t-\r]+", text), []
    sign, close = r"(?::=|=>|[:=]{1,2})", r"[\"'\])]*"
    has = lambda p, s: re.search(p, s, re.I) is not None
    mixed = lambda s: has(r"[0-9]", s) and has(r"[a-z]", s)
    for i, x in enumerate(words):
        one, two, three = (words[i - k] if i >= k else None for k in (1, 2, 3))
        values = [m[1] for m in [re.search(r"[A-Za-z0-9]://[^\s/:@]*:([^\s/@]{4,})@", x)] if m]
        m = re.match(r"-p[\"']?([^\s\"',;]{4,})", x)
        if m and mixed(x[m.start(1) :]):
            values.append(m[1])
        m = re.search(rf"{NAME}[\"']?[:=][\"']?([^\"',;]{{4,}})", x, re.I)
        told = False
        if len(x) >= 4 and one is not None:
            told = has(rf"{NAME}{close}{sign}[\"']?$", one) or (has(rf"^{sign}[\"']?$", one) and two is not None and has(rf"{NAME}{close}$", two)) or (has(rf"^{sign}", x) and has(rf"{NAME}{close}$", one))
            told = told or (has(rf"^--?[a-z_\-]*{NAME}$", one) and not x.startswith("-")) or (has(r"^[\"']?(?:basic|bearer)$", one) and two is not None and has("authorization", two))
            by = " ".join(w for w in ((three, two) if has(r"^(?:is|was):?$", one) else (two, one)) if w is not None)
            told = told or (mixed(x) and has(rf"{NAME}{close}(?:\s+(?:key|phrase))?$", by))
        own = m[1] if m else None
        if own is None and told:
            m = re.match(rf"{sign}?[\"'`]?([^\"'`,;]{{4,}})", x)
            own = m[1] if m else None
        if own is not None:
            own = re.sub(r"[^A-Za-z0-9_+/=\-]+$", "", own)
            values += [own] if own not in values else []
        elif not values:
            values = [m[0] for m in re.finditer(r"(?<![A-Za-z0-9_+/\-])(?=[A-Za-z_+/\-]*[0-9])[A-Za-z0-9_+/\-]{12,}={0,2}", x)]
        out += [(i, v) for v in values if len(v) >= 4]
    return out


def test_candidates_against_a_plain_scan(spark):
    r = random.Random(5)
    bits = [
        "password", "the", "token", '"secret":', "=", ":", ":=", "pwd=a1b2c", "auth", "is", "was", "key", "hunter2x", "word", "--password", "-pAb12cd", "-print", "Authorization:", "Basic", "Bearer", "abc12,", "0123456789abcdef", "postgres://a:b1c2@h/x", "https://h:80/p",
        "token='x1y2z3'", "secret=", "'quoted1'", "x", "a/b-c_d12345678", "api_key=>v4lue9", "my-secret", "credential", "(private", "key)", "1234", "é1abc", "://a:long1@", "tokens", "author",
    ]
    texts = [r.choice(["", " "]) + r.choice([" ", "\n", "  "]).join(r.choices(bits, k=r.randrange(1, 14))) for _ in range(600)] + ["", "password", None]
    found = {}
    for row in secrets.candidates(spark.createDataFrame([(i, t, None) for i, t in enumerate(texts)], "doc_id long, text string, source string")).collect():
        found.setdefault(row.doc_id, []).append((row.word, row.value))
    for i, t in enumerate(texts):
        assert sorted(found.get(i, [])) == sorted(plain_candidates(t or "")), t


def test_short_values_go_only_where_they_stand_alone(spark):
    docs = frame(spark, ["pwd=a1b2c and xa1b2cx then a1b2c."])
    (got,) = secrets.redact(docs).where("doc_id = 0").collect()
    assert got.text == "pwd=[secret] and xa1b2cx then [secret]."

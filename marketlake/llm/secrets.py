r"""Secret scans: candidates by patterns, false positives removed by a random forest. DataFrame functions and Spark's own ML.

A candidate is a run of at least 12 key characters with a digit in it, a JSON web token, a block with a private key, what
is assigned to a name such as `password`, with or without white space around the sign, the password of a URL, what follows
an option (`-pVALUE`, `--password VALUE`), the credentials of basic or bearer authorization, or what is said of a name
("the password was VALUE", with a letter and a digit in it). Such values have 4 characters or more.
The forest looks at its length, its transitions between classes of characters, how far words of the corpus cover its
letters, the path it comes from and the words beside it. It is trained from labelled findings: those that a caller gives,
and a small set of our own (`taught`), made by rule from the ways in which secrets, and what looks like them, are written.
No label comes from the corpus or from the features. Values in a format that a provider publishes and private keys are
secrets whatever the forest says; it decides on all others, so that hashes, numbers, ids, placeholders and calls drop out.

Candidates whose probability is at least `THRESHOLD` are secrets.
"""

from __future__ import annotations

from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from marketlake.llm.common import sieve, sift, written

THRESHOLD = 0.5
#: Labelled findings of a caller that a forest is trained on at most, half of them of each label: those whose value has the smallest hash.
MOST_LABELLED = 20_000
#: A word of four letters or more is in the dictionary if it is this share of all such words, and comes twice.
SHARE = 1e-6
GRAM = 4

# Names that secrets are assigned to, and shapes that providers publish.
NAMES = r"passw(?:or)?d|passwd|pwd|secret(?:_?key)?|token|api_?key|access_?key|auth|credential|private(?:[_\-]|\s+)?key"
KNOWN = r"^(?:(?:AKIA|ASIA)[0-9A-Z]{16}|gh[pousr]_[0-9A-Za-z]{36}|glpat-[0-9A-Za-z_\-]{20}|npm_[0-9A-Za-z]{36}|xox[abpr]-[0-9A-Za-z-]{10,}|[rs]k_live_[0-9A-Za-z]{24,}|sk-(?=[^\s]*[0-9])(?=[^\s]*[A-Z])[0-9A-Za-z_\-]{20,}|AIza[0-9A-Za-z_\-]{35}|eyJ[0-9A-Za-z_\-]{10,}\.[0-9A-Za-z_\-.]{10,})$"

#: Characters that an assigned value has at least. Values under WHOLE characters are replaced where they stand alone only.
SHORTEST, WHOLE = 4, 6
_RUN = r"[A-Za-z0-9_+/\-]{12,}={0,2}"
_SPLIT = r"[\x20\x09-\x0D]+"
#: A whole run with a digit in it, or a known key without one.
_JWT = r"eyJ[0-9A-Za-z_\-]{10,}\.[0-9A-Za-z_\-.]{9,}[0-9A-Za-z_\-]"
_KEY = rf"(?<![A-Za-z0-9_+/\-])(?:{_JWT}|(?:(?=[A-Za-z_+/\-]*[0-9])|(?=A[KS]IA[0-9A-Z]{{16}}|gh[pousr]_|glpat-|npm_|xox[abpr]-|[rs]k_live_|AIza)){_RUN})"
_ASSIGNED = rf"(?i)(?:{NAMES})[\"']?[:=][\"']?([^\"',;]{{{SHORTEST},}})"
#: A sign of assignment, a name before it, and the value that follows as the next word.
_SIGN = r"(?::=|=>|[:=]{1,2})"
_NAME = rf"(?i)(?:{NAMES})[\"'\])]*"
_FOLLOWS = rf"^{_SIGN}?[\"'`]?([^\"'`,;]{{{SHORTEST},}})"
_SPACED = rf"{_NAME}(?:\s+{_SIGN}|{_SIGN}[\"']?\s)"
#: A letter and a digit in what follows, up to the next white space.
_MIXED = r"(?=[^\s]*[0-9])(?=[^\s]*[A-Za-z])"
#: The password in a URL, and one that is written to an option of one letter.
_IN_URL = rf"[A-Za-z0-9]://[^\s/:@]*:([^\s/@]{{{SHORTEST},}})@"
_SHORT_OPTION = rf"^-p[\"']?{_MIXED}([^\s\"',;]{{{SHORTEST},}})"
#: What stands before a value: an option by name, a scheme of authorization, words that say it.
_OPTION = rf"(?i)^--?[A-Za-z_\-]*(?:{NAMES})$"
_SCHEME = r"(?i)^[\"']?(?:basic|bearer)$"
_SAID = rf"{_NAME}(?:\s+(?:key|phrase))?(?:\s+(?:is|was):?)?"
#: The markers of a private key's block, and what lines of one that is cut off are made of.
_OF_KEY = r"(?:[A-Z0-9]+ ){0,3}PRIVATE KEY(?: BLOCK)?-----"
_BEGIN = rf"-----BEGIN {_OF_KEY}"
_LINES = r"^[A-Za-z0-9+/=\s\\]*+"
#: What a text must hold for any of its words to be a candidate.
_BEFORE = rf"(?i)(?:^|\s)--?[A-Za-z_\-]*(?:{NAMES})\s|authorization[\"']?\s*[:=]?\s*[\"']?(?:basic|bearer)\s|{_SAID}\s+[\"'`]?{_MIXED}"
_ANY = rf"{_KEY}|{_BEGIN}|{_IN_URL}|(?:^|\s)-p[\"']?{_MIXED}|{_NAME}\s*{_SIGN}|{_BEFORE}"
# What stands in the place of a secret.
PLAIN = rf"(?i)^(?:none|null|nil|true|false|undefined|string|integer|boolean|bytes|required|optional|missing|invalid|expired|disabled|enabled|unknown|hidden|redacted|example|(?:your|my|the|some)[_\-].*|x+|(?:{NAMES})s?|[a-z]+://[^@]*|[a-z_]+(?:\.[a-z_]+)+)$|[(){{}}\[\]<>$%]"
#: Transitions between classes of characters, as shares of the length.
CLASSES = {"lower": "a-z", "upper": "A-Z", "digit": "0-9"}
FEATURES = ["length", "coverage", "path_depth", "path_test", "told", "in_url", "option", "scheme", "said", "stand_in", "bare_word", "named_inside", "named_before", "assigned", "quoted", "word_before", "word_after", *(f"share_{c}" for c in CLASSES), *(f"{a}_{b}" for a in CLASSES for b in CLASSES)]


def _block(part: Column) -> Column:
    """The private key that a text begins with, of any length: up to its end marker, or all lines of 16 characters or more that follow; empty if there is none."""
    closed = F.regexp_extract(part, rf"(?s)^{_BEGIN}.*?-----END {_OF_KEY}", 0)
    head = F.regexp_extract(part, f"^{_BEGIN}", 0)
    rest = F.substring(part, F.length(head) + 1, F.length(part))
    # line ends may be written out; in their place come spaces, so that places stay the same
    lines = F.regexp_replace(F.regexp_extract(rest, _LINES, 0), r"\\[nr]", "  ")
    whole = F.regexp_replace(lines, r"(?s)\s++(?![A-Za-z0-9+/=]{16}).*$", "")
    cut = F.when(whole.rlike(r"^\s"), F.concat(head, F.substring(rest, F.lit(1), F.length(whole)))).otherwise("")
    return F.when(F.length(head) == 0, "").when(F.length(closed) > 0, closed).otherwise(cut)


def candidates(docs: DataFrame, path: str | None = "source", id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row for each candidate: doc_id, doc_key (a hash of the text), word (its place), number (inside the word), value, before, after, inside, path.

    A null text has none; a row with a null id has its candidates under a null id. The whole text is split at white space; a
    word may hold several candidates, and repeated rows give theirs again. Other columns are not read.
    """
    text = F.col(text_col)

    def of(docs: DataFrame) -> DataFrame:
        rows = docs.select(
            F.col(id_col).alias("doc_id"), F.xxhash64(text).alias("doc_key"), (F.col(path) if path else F.lit(None)).cast("string").alias("path"), F.split(text, _SPLIT).alias("w"),
            text.rlike(rf"{_SPACED}|{_BEFORE}").alias("spaced"), F.when(text.contains("-----BEGIN "), F.split(text, f"(?={_BEGIN})")).otherwise(F.array().cast("array<string>")).alias("pieces"),
        )
        found = F.transform("pieces", lambda p, i: F.struct(_block(p).alias("value"), i.alias("at")))
        rows = rows.withColumn("pems", F.filter(found, lambda b: F.length(b["value"]) > 0))
        return rows.withColumn("within", F.flatten(F.transform("pems", lambda b: F.split(b["value"], _SPLIT))))

    rows = of(docs.where(text.rlike(_ANY)))

    def told(x: Column, i: Column) -> Column:
        """Whether a word follows a telling name and a sign, an option, a scheme of authorization or words that say it."""
        one, two, three = (F.get("w", i - k) for k in (1, 2, 3))
        after = one.rlike(rf"{_NAME}{_SIGN}[\"']?$") | (one.rlike(rf"^{_SIGN}[\"']?$") & two.rlike(rf"{_NAME}$")) | (x.rlike(rf"^{_SIGN}") & one.rlike(rf"{_NAME}$"))
        option = one.rlike(_OPTION) & ~x.startswith("-")
        scheme = one.rlike(_SCHEME) & two.rlike("(?i)authorization")
        verb, last = one.rlike("(?i)^(?:is|was):?$"), F.concat_ws(" ", three, two)
        said = x.rlike(rf"^[\"'`]?{_MIXED}") & F.when(verb, last).otherwise(F.concat_ws(" ", two, one)).rlike(rf"{_NAME}(?:\s+(?:key|phrase))?$")
        return F.coalesce(F.col("spaced") & (F.length(x) >= SHORTEST) & (after | option | scheme | said), F.lit(False))

    marked = F.filter(F.transform("w", lambda x, i: F.struct(i.alias("i"), x.alias("x"), told(x, i).alias("told"))), lambda p: (p["told"] | p["x"].rlike(rf"{_KEY}|{_IN_URL}|{_SHORT_OPTION}|{_ASSIGNED}")) & ~F.array_contains("within", p["x"]))
    near = F.transform(
        marked,
        lambda p: F.struct(p["i"].alias("i"), p["x"].alias("x"), p["told"].alias("told"), F.array(*(F.get("w", p["i"] - k) for k in (3, 2, 1))).alias("before"), F.get("w", p["i"] + 1).alias("after")),
    )
    found = rows.select("doc_id", "doc_key", "path", F.explode(near).alias("p"))
    # a URL's password or an option's value and the value assigned inside the word; else one told of by the words before, else every run with a digit
    held = F.filter(F.array(F.regexp_extract("p.x", _IN_URL, 1), F.regexp_extract("p.x", _SHORT_OPTION, 1)), lambda v: F.length(v) > 0)
    own = F.regexp_extract("p.x", _ASSIGNED, 1)
    own = F.when(F.length(own) > 0, own).when(F.col("p.told"), F.regexp_extract("p.x", _FOLLOWS, 1)).otherwise("")
    runs = F.regexp_extract_all("p.x", F.lit(rf"({_KEY})"), F.lit(1))
    one = F.when(F.length(own) > 0, F.array(F.regexp_replace(own, r"[^A-Za-z0-9_+/=\-]+$", ""))).otherwise(F.array().cast("array<string>"))
    values = F.when((F.size(held) == 0) & (F.length(own) == 0), runs).otherwise(F.array_distinct(F.concat(held, one)))
    found = found.select("doc_id", "doc_key", "path", F.col("p.i").cast("int").alias("word"), F.col("p.x").alias("inside"), F.col("p.before").alias("before"), F.col("p.after").alias("after"), F.posexplode(values).alias("number", "value"))
    found = found.where((F.length("value") >= SHORTEST) & ~F.col("value").startswith("-----BEGIN"))
    # a private key is one value, at the place of its first word
    blocks = of(docs.where(text.contains("-----BEGIN "))).where(F.size("pems") > 0).select("*", F.posexplode("pems").alias("number", "b"))
    ahead = F.array_join(F.slice("pieces", F.lit(1), F.col("b.at")), "")
    blocks = blocks.withColumn("value", F.col("b.value"))
    blocks = blocks.withColumn("word", F.size(F.split(ahead, _SPLIT)) - 1)
    before = F.array(*(F.get("w", F.col("word") - k) for k in (3, 2, 1)))
    after = F.get("w", F.col("word") + F.size(F.split("value", _SPLIT)))
    return found.unionByName(blocks.select("doc_id", "doc_key", "path", "word", F.col("value").alias("inside"), before.alias("before"), after.alias("after"), "number", "value"))


def common_words(docs: DataFrame, text_col: str = "text", share: float = SHARE) -> DataFrame:
    """w, n: the words of four letters or more that are common in all texts; at most 1 / share of them, whatever the corpus."""
    words = docs.select(F.explode(F.split(F.lower(text_col), r"[^\p{L}]+")).alias("w")).where(F.length("w") >= GRAM)
    counts = written(words.groupBy("w").agg(F.count("*").alias("n")), "words")
    least = counts.agg(F.greatest(F.lit(2.0), F.sum("n") * share).alias("least"))  # one row
    return counts.join(F.broadcast(least), F.col("n") >= F.col("least")).select("w", "n")


def dictionary(words: DataFrame) -> DataFrame:
    """gram: the runs of four letters in the words."""
    return words.select(F.explode(_grams(F.col("w"))).alias("gram")).distinct()


def _grams(word: Column) -> Column:
    return F.when(F.length(word) >= GRAM, F.transform(F.sequence(F.lit(1), F.length(word) - (GRAM - 1)), lambda i: F.substring(word, i, F.lit(GRAM)))).otherwise(F.array().cast("array<string>"))


def with_features(found: DataFrame, grams: DataFrame) -> DataFrame:
    """Adds the features to candidates."""
    values = found.select("value").distinct()
    runs = values.select("value", F.explode(F.filter(F.split(F.lower("value"), r"[^\p{L}]+"), lambda r: F.length(r) >= GRAM)).alias("run"))
    gram = runs.select("value", F.explode(_grams(F.col("run"))).alias("gram"))
    cover = gram.join(grams.withColumn("known", F.lit(1)), "gram", "left").groupBy("value").agg((F.count("known") / F.count("*")).alias("coverage"))
    df = found.join(cover, "value", "left")
    v, size = F.col("value"), F.length("value")
    count = lambda pattern: F.regexp_count(v, F.lit(pattern)) / size
    before = F.lower(F.concat_ws(" ", "before"))
    flag = lambda c: F.coalesce(c, F.lit(False)).cast("double")
    p = F.coalesce(F.lower("path"), F.lit(""))
    head = F.call_function("substring_index", F.concat_ws(" ", F.concat_ws(" ", "before"), "inside"), v, F.lit(1))
    tail = F.call_function("substring_index", F.col("inside"), v, F.lit(-1))
    cols = {
        "told": flag(head.rlike(rf"{_NAME}\s*{_SIGN}\s*[\"']?$")),
        "in_url": flag(head.rlike(r"://[^\s/:@]*:$")),
        "option": flag(head.rlike(rf"(?i)(?:^|\s)(?:-p|--?[A-Za-z_\-]*(?:{NAMES})\s+)[\"']?$")),
        "scheme": flag(head.rlike(r"(?i)authorization[\"']?\s*[:=]?\s*[\"']?(?:basic|bearer)\s+$")),
        "said": flag(head.rlike(rf"{_SAID}\s+[\"'`]?$")),
        "stand_in": flag(v.rlike(PLAIN) | tail.rlike(r"^[(\[]")),
        "bare_word": flag(~v.rlike(r"[^\p{L}]") & ~head.rlike(rf"[\"']$|{_NAME}{_SIGN}$|://[^\s/:@]*:$")),
        "length": size.cast("double"),
        "coverage": F.coalesce("coverage", F.lit(0.0)),
        "path_depth": F.regexp_count(p, F.lit("/")).cast("double"),
        "path_test": flag(p.rlike("test|example|fixture|sample|docs?/|mock")),
        "named_inside": flag(F.col("inside").rlike(f"(?i){NAMES}")),
        "named_before": flag(before.rlike(f"(?i){NAMES}")),
        "assigned": flag(before.rlike(r"[:=]\W*$") | F.col("inside").rlike(r"[A-Za-z\"'][:=]")),
        "quoted": flag(F.col("inside").rlike("[\"']")),
        "word_before": flag(F.get("before", F.lit(2)).rlike(r"^\p{L}+$")),
        "word_after": flag(F.col("after").rlike(r"^\p{L}+$")),
        **{f"share_{c}": count(f"[{r}]") for c, r in CLASSES.items()},
        **{f"{a}_{b}": count(f"(?<=[{ra}])[{rb}]") for a, ra in CLASSES.items() for b, rb in CLASSES.items()},
    }
    return df.withColumns({k: F.coalesce(c.cast("double"), F.lit(0.0)) for k, c in cols.items()})


# How secrets are written ({n} a name, {v} a value), and what looks like one.
WRITTEN = ["{n}={v}", '{n} = "{v}"', "{n}: {v}", '"{n}": "{v}",', "{n} := {v}", "{n} ='{v}'", "export {n}={v}", "--{n}={v} run", "mysql://root:{v}@db.example.com/app", "connect -h db -p{v} app", "tool --{n} {v} run", "Authorization: Basic {v}", '"Authorization": "Bearer {v}"', "the {n} was {v}", "{n} is {v} now", "the AWS {n} {v}"]
CALLED = ["password", "passwd", "pwd", "secret", "token", "api_key", "API_KEY", "access_key", "auth_token", "client_secret", "db_password", "TOKEN"]
HARMLESS = [
    "commit {hex40}", "revision {hex40} of", "sha1 {hex40}", "md5: {hex32}", "checksum {hex40}", 'etag "{hex32}"', "card {digits16}", "{digits16}", "number {digits14} was", "the id {uuid} of", "build {version} and",
    "isbn {digits13}", "on {date} it", "file {path} is", "see {url} for", "version {version}", "{name}_{digits8}_{name}", "{name}-{name}-{digits8}", 'token = "{stand_in}"', "password: {stand_in}", "password: {word}", "secret = {word}", "the token: {word} and",
    "password={call}", "auth = {call}", "api_key = {stand_in}", "token={stand_in}", "passwd = {word}", "password: {word}", "tokens: {digits16}", "image {base64}", "data {hex32} end",
    "redis://{word}:{stand_in}@localhost/0", "the --password {word} option", "--token {stand_in} here", "--secret {word}", "the token is {digits16}", "password is {stand_in}", "the token v{version} of", "token = {digits4}", "auth: {digits4}",
    "password: {short}", "token = {short}", "secret={short}", "the secret {name}-{digits4} and", "auth {name}_v{digits4}", "Authorization: Basic {word}", "sk-{name}-{word}-{digits8}",
]
PLACEHOLDERS = ["None", "True", "Undefined", "false", "your_password_1", "your-token-here", "example", "changed", "my_secret_2", "xxxxxxxx", "REDACTED", "undefined", "required", "unknown"]
SHORT = "None True Null here that with from used true when also this none".split()
COMMON = "wherever another present without picture history morning country general service machine station weather holiday kitchen library evening journey quarter teacher".split()


def taught(words: DataFrame) -> DataFrame:
    """Labelled findings with the columns of `candidates` and `label`: values made by rule, in the contexts above.

    The words in them are the 64 most common of the corpus (w, n) and our own, half each, so that dictionary coverage is taught as well.
    """
    spark, n = words.sparkSession, F.col("id")
    top = [r["w"] for r in words.where(F.length("w").between(5, 12)).orderBy(F.desc("n"), "w").limit(64).collect()]  # 64 words
    lexicon = [*COMMON * 3, *(top or COMMON)]
    pick = lambda items, k: F.element_at(F.array(*map(F.lit, items)), (F.pmod(k, F.lit(len(items))) + 1).cast("int"))
    sha = F.sha1(n.cast("string"))
    dec = lambda k: F.substring(F.translate(F.sha2(n.cast("string"), 256), "abcdef", "123456"), 1, k)
    code = F.regexp_replace(F.base64(F.unhex(F.sha2(n.cast("string"), 256))), "[+/=]", "")
    word, other = pick(lexicon, F.xxhash64(n)), pick(lexicon, F.xxhash64(n, n))
    kinds = {
        "hex40": sha, "hex32": F.md5(n.cast("string")), "digits16": dec(16), "digits14": dec(14), "digits13": dec(13), "digits8": dec(8), "digits4": dec(4), "short": pick(SHORT, F.xxhash64(n)), "base64": code, "word": word, "name": other, "call": F.concat(F.lit("getenv("), word, F.lit(")")), "stand_in": pick(PLACEHOLDERS, F.xxhash64(n + 1)),
        "uuid": F.regexp_replace(F.md5(n.cast("string")), "^(.{8})(.{4})(.{4})(.{4})(.{12})$", "$1-$2-$3-$4-$5"), "version": F.concat_ws(".", dec(1), (n % 40).cast("string"), dec(8)), "date": F.concat(F.date_add(F.lit("2020-01-01"), n.cast("int")).cast("string"), F.lit("T10:20:30")),
        "path": F.concat(F.lit("/"), word, F.lit("/"), other, F.lit("/part-"), dec(5)), "url": F.concat(F.lit("https://"), word, F.lit(".example.com/"), other, F.lit("/"), dec(6)),
    }
    values = [sha, F.upper(sha), F.md5(n.cast("string")), F.substring(code, 1, 20), code, F.substring(code, 3, 10), F.concat(word, dec(2)), F.concat(word, other), dec(8), F.concat(F.initcap(word), F.lit("!"), dec(3)), F.concat(F.substring(word, 1, 6), dec(1)), F.concat(F.substring(word, 1, 3), dec(4)), F.concat(F.substring(word, 2, 2), dec(3)), F.substring(code, 1, 40), F.translate(F.substring(code, 5, 9), "0123456789", "abcdefghij")]
    times = len(CALLED) * len(WRITTEN) * len(values)
    value = F.element_at(F.array(*values), (F.pmod(n, F.lit(len(values))) + 1).cast("int"))
    form = pick(WRITTEN, F.floor(n / len(values)))
    yes = spark.range(times).select(n, F.lit(1.0).alias("label"), word.alias("ahead"), other.alias("behind"), value.alias("own"), form.alias("form"), pick(CALLED, F.floor(n / (len(values) * len(WRITTEN)))).alias("n"))
    # letters alone, bare after white space, may be a word of the sentence: of these only those longer than words are are taught
    yes = yes.where(F.col("own").rlike("[^a-z]") | ~F.col("form").rlike(r"\s\{v\}") | (F.length("own") >= 15)).select("id", "label", "ahead", "behind", "own", F.replace(F.replace("form", F.lit("{n}"), F.col("n")), F.lit("{v}"), F.col("own")).alias("said"))
    said = pick(HARMLESS, n)
    for k, v in kinds.items():
        said = F.replace(said, F.lit(f"{{{k}}}"), v)
    no = spark.range(times, 2 * times).select(n, F.lit(0.0).alias("label"), word.alias("ahead"), other.alias("behind"), F.lit(None).cast("string").alias("own"), said.alias("said"))
    texts = yes.unionByName(no).select(n.alias("doc_id"), "label", "own", F.lit(None).cast("string").alias("source"), F.concat_ws(" ", "ahead", pick(["", "uses", "the", "of", "here,"], n * 3), "said", "behind").alias("text"))
    texts = written(texts.coalesce(1), "taught")  # a few thousand short rows
    found = written(candidates(texts), "findings")
    return found.join(texts.select("doc_id", "label", "own"), "doc_id").where("label = 0 or value = own").drop("own")


def train(labelled: DataFrame, more: DataFrame | None = None, trees: int = 30, depth: int = 8, most: int = MOST_LABELLED) -> RandomForestClassificationModel:
    """A forest from rows with the features and `label`. Of `more` (a caller's findings) at most `most` different values are taken, half of each label."""
    own = labelled.select("label", *FEATURES)
    if more is not None:
        one = more.dropDuplicates(["label", "value"]).withColumn("h", F.xxhash64("value"))
        first = one.withColumn("rank", F.row_number().over(Window.partitionBy("label").orderBy("h", "value"))).where(F.col("rank") <= most // 2)
        own = own.unionByName(first.select(F.col("label").cast("double").alias("label"), *FEATURES))
    sample = written(own, "labelled")
    rows = VectorAssembler(inputCols=FEATURES, outputCol="x").transform(sample.orderBy("label", *FEATURES).coalesce(1)).select("x", "label")  # bounded
    return RandomForestClassifier(featuresCol="x", labelCol="label", numTrees=trees, maxDepth=depth, seed=1).fit(rows)


def score(featured: DataFrame, model: RandomForestClassificationModel) -> DataFrame:
    """Adds `probability`: the forest's, and 1 for published formats and private keys."""
    df = VectorAssembler(inputCols=FEATURES, outputCol="x").transform(featured)
    v = F.col("value")
    sure = v.rlike(KNOWN) | v.startswith("-----BEGIN")
    df = model.setProbabilityCol("p").transform(df).withColumn("probability", F.when(sure, 1.0).otherwise(vector_to_array("p")[1]))
    return df.drop("x", "p", "rawPrediction", "prediction")


def scan(docs: DataFrame, labelled: DataFrame | None = None, path: str | None = "source") -> DataFrame:
    """Every candidate of every row: doc_id, doc_key, word, number, value, probability, is_secret.

    labelled: findings with a label of 0 or 1 and the columns of `candidates`, learnt from beside our own. Repeated rows
    give their findings again; a null or empty text and an empty table give none.
    """
    found = written(candidates(docs, path), "candidates")
    words = written(common_words(docs), "common")
    grams = written(dictionary(words), "grams")
    featured = written(with_features(found, grams), "featured")
    model = train(with_features(taught(words), grams), None if labelled is None else with_features(labelled, grams))
    return score(featured, model).select("doc_id", "doc_key", "word", "number", "value", "probability", (F.col("probability") >= THRESHOLD).alias("is_secret"))


def redact(docs: DataFrame, mark: str = "[secret]", path: str | None = "source") -> DataFrame:
    """All rows, with each secret in their text replaced by the mark (and n_chars, if there is one, made to fit).

    A row with a null id or text, and one without a secret, stays as it is. Texts without secrets are not shuffled.
    """
    found = scan(docs, path=path).where("is_secret").groupBy("doc_key").agg(F.collect_set("value").alias("values"))  # of one text
    found = written(found, "secrets")
    held = sieve(found, "doc_key")
    packed = docs.select(F.struct("*").alias("row"), F.xxhash64("text").alias("key"))
    df = sift(packed, "key", held).join(found, F.col("key") == F.col("doc_key"), "left")
    # longer values first, so that one that holds another goes whole
    values = F.expr("array_sort(values, (a, b) -> case when length(a) <> length(b) then length(b) - length(a) when a < b then -1 when a > b then 1 else 0 end)")
    text = F.col("row.text")

    def without(t: Column, v: Column) -> Column:
        """A short value goes where it stands alone; inside a longer run the same letters mean nothing."""
        escaped = F.regexp_replace(v, r"([^A-Za-z0-9])", r"\\$1")
        alone = F.regexp_replace(t, F.concat(F.lit("(?<![A-Za-z0-9])"), escaped, F.lit("(?![A-Za-z0-9])")), F.lit(mark.replace("\\", "\\\\").replace("$", "\\$")))
        return F.when(F.length(v) < WHOLE, alone).otherwise(F.replace(t, v, F.lit(mark)))

    clean = F.when(F.col("values").isNull(), text).otherwise(F.aggregate(values, text, without))
    df = df.withColumn("row", F.col("row").withField("text", clean))
    if "n_chars" in docs.columns:
        size = F.length("row.text").cast(docs.schema["n_chars"].dataType)
        df = df.withColumn("row", F.col("row").withField("n_chars", F.when(F.col("values").isNull(), F.col("row.n_chars")).otherwise(size)))
    return df.select("row").unionByName(sift(packed, "key", held, out=True).select("row")).select("row.*")


def report(docs: DataFrame) -> DataFrame:
    """doc_id, word, number, value, probability, is_secret of every candidate of every row; see `scan`."""
    return scan(docs).drop("doc_key")

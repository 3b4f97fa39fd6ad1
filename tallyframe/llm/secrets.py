"""Secret scan: candidate tokens, and a random forest that tells secrets from look-alikes. DataFrame functions only."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyframe.llm.rowwise import in_training
from tallyframe.sources.shared import settle

_PLAIN = "[A-Za-z0-9+/_\\\\-]"
_TOKEN = "[A-Za-z0-9+/_=\\\\-]"
#: Words that announce a secret.
ANNOUNCING = "token|secret|passw|pwd|api|apikey|access|auth|bearer|credential|private|signature|key"
#: What stands between a name and its value.
_ASSIGNS = "[\"'`\\])\\\\]{0,3}\\s?(?:=>|:=|==?|:)\\s?[\"'`(\\[\\\\]{0,3}"
#: The end of a text that assigns to a name with an announcing word in it.
_NAMED = f"(?i:{ANNOUNCING})[A-Za-z0-9_.-]{{0,40}}{_ASSIGNS}"
#: Forms of keys that issuers give out, known without any announcement.
KNOWN_FORMS = (
    "^(?:(?:AKIA|ASIA)[0-9A-Z]{16}|gh[pousr]_[A-Za-z0-9]{36,}|github_pat_[A-Za-z0-9_]{22,}|glpat-[A-Za-z0-9_-]{20,}"
    "|xox[abeoprs]-[0-9][A-Za-z0-9-]{9,}|sk-(?=[^0-9]*[0-9])[A-Za-z0-9_-]{20,}|[rs]k_(?:live|test)_[A-Za-z0-9]{16,}"
    "|AIza[A-Za-z0-9_-]{35}|npm_[A-Za-z0-9]{36}|pypi-[A-Za-z0-9_-]{50,}|hf_[A-Za-z0-9]{30,}|dop_v1_[0-9a-f]{64})$")
#: Words that announce something else that looks alike.
HARMLESS = "commit|sha1|sha256|md5|checksum|digest|hash|revision|uuid|guid|isbn|card|phone|image|version|http|www|file|page"
#: Words of made-up values.
MADE_UP = "example|sample|dummy|placeholder|changeme|redacted|your|test|fake|xxxx|0000000|1234567"
#: Frequent words and word parts of several languages, for the share of a token that they cover.
DICTIONARY = (
    "the and ing tion ent ment that for with this have from they will what which their there other about there able ance "
    "ence ness ight ough ould ever over under out ion ers est ist ous ive ful ish que pour dans avec est les des une sur par "
    "elle tre eur aux eau der die das und ein ich ung keit heit lich sch ver ber auf mit von los las del para como esta cion "
    "mente ado ando dad ero ella user name data file path config class string value number page site home index list").split()
FEATURES = (
    "length", "transitions", "digits", "capitals", "others", "distinct", "hexadecimal", "vowels", "covered", "announced",
    "assigned", "named", "known_form", "quoted", "harmless", "made_up", "letters_before", "path_depth", "path_tests", "path_settings")


def candidates(
    df: DataFrame, key: Sequence[str] = ("doc_id",), text: str = "text", path: str = "source", least: int = 16, least_named: int = 4,
) -> DataFrame:
    """The key columns, word_no, token_no, token, its neighbours and path: a row per run of `least` token characters or more,
    and per run of `least_named` or more that is assigned to a name with an announcing word.

    A run is parted at its first '=' that is no padding: the name belongs to the neighbours of the value, and is a candidate
    itself if it is long enough; '=' alone is none. Words are separated by white space; neighbours are three words before
    and one after, and the word's own text before the token, from the second last token on. Every run of every whole text counts; NULL texts have none.
    """
    name = f"{_PLAIN}{{{least},}}+(?==+{_PLAIN})"
    value = f"(?!=)(?:(?<==)|(?!{_PLAIN}*+=++{_PLAIN})){_TOKEN}{{{least},}}"
    short = f"(?<=[=:>\"'`(\\[\\\\\\s])(?!=)(?<={_NAMED}){_TOKEN}{{{least_named},{least - 1}}}(?!{_TOKEN})"
    # the words before, a line break, the word: each match is what comes before a token, from the last one on, and the token
    run = f"(?s)\\G((?:^[^\\n]*+\\n)?+.*?)({name}|{value}|{short})"
    word = F.split(F.col(f"`{text}`").cast("string"), "\\s+")
    path_column = F.coalesce(F.col(f"`{path}`").cast("string"), F.lit("")) if path in df.columns else F.lit("")
    words = df.select(*(F.col(f"`{k}`") for k in key), path_column.alias("__path"), word.alias("__words"))

    def worth_a_look(w: Column, i: Column) -> Column:
        last = F.get("__words", i - 1)
        assigned = F.contains(w, F.lit("=")) | F.contains(w, F.lit(":")) | last.endswith("=") | last.endswith(":") | last.endswith("=>")
        return (F.length(w) >= least) | (F.length(w) >= least_named) & assigned

    looked_at = F.filter(
        F.transform("__words", lambda w, i: F.when(worth_a_look(w, i), F.struct(i.alias("i"), w.alias("w")))),
        lambda x: x.isNotNull())
    # outer: a filter on what is unfolded would be moved below and split the text again, for each word
    near = words.withColumn("__long", looked_at).withColumn("__long", F.transform("__long", lambda x: F.struct(
        x.i.alias("i"), x.w.alias("w"),
        F.array_join(F.slice("__words", F.greatest(x.i - 2, F.lit(1)), F.least(x.i, F.lit(3))), " ").alias("before"),
        F.coalesce(F.get("__words", x.i + 1), F.lit("")).alias("after"))))
    one = near.select(*key, "__path", F.explode_outer("__long").alias("x")).where("x is not null").select(
        *key, "__path", F.col("x.i").cast("bigint").alias("word_no"), F.col("x.after").alias("after"),
        F.concat("x.before", F.lit("\n"), "x.w").alias("__text"))
    parted = one.select(
        *key, "__path", "word_no", "after", F.regexp_extract_all("__text", F.lit(run), 1).alias("__gaps"),
        F.regexp_extract_all("__text", F.lit(run), 2).alias("__tokens"))
    # the last two tokens before with what is around them, so that a word of many tokens costs as much as its length
    last = lambda pieces, i: F.slice(pieces, F.greatest(i - 1, F.lit(1)), F.least(i, F.lit(2)))
    up_to = lambda i: F.array_join(F.zip_with(last("__gaps", i), last("__tokens", i), lambda g, t: F.concat(g, t)), "")
    tokens = F.transform("__tokens", lambda t, i: F.struct(
        t.alias("token"), F.translate(F.concat(F.when(i > 0, up_to(i)).otherwise(""), F.get("__gaps", i)), "\n", " ").alias("before")))
    return parted.select(*key, "__path", "word_no", "after", F.posexplode_outer(tokens).alias("token_no", "x")).where("x is not null").select(
        *key, "word_no", F.col("token_no").cast("bigint").alias("token_no"), "x.token", "x.before", "after", F.col("__path").alias("path"))


def _share(pattern: str, of: Column) -> Column:
    """Share of the characters that match."""
    return 1 - F.length(F.regexp_replace(of, pattern, "")) / F.length(of)


def _has(words: str, of: Column) -> Column:
    return F.lower(of).rlike(words).cast("double")


def with_features(found: DataFrame) -> DataFrame:
    """FEATURES as double columns, from token, before, after and path."""
    token, before, around = F.col("token"), F.col("before"), F.concat_ws(" ", "before", "token", "after")
    kinds = F.regexp_replace(F.regexp_replace(F.regexp_replace(token, "[a-z]+", "a"), "[A-Z]+", "b"), "[0-9]+", "c")
    split = F.regexp_replace(kinds, "[^abc]+", "d")
    low = F.lower(token)
    values = {
        "length": F.log2(F.length(token)),
        "transitions": (F.length(split) - 1) / F.length(token),
        "digits": _share("[0-9]", token),
        "capitals": _share("[A-Z]", token),
        "others": _share("[^A-Za-z0-9]", token),
        "distinct": F.size(F.array_distinct(F.split(token, ""))) / F.length(token),
        "hexadecimal": low.rlike("^[0-9a-f]+$").cast("double"),
        "vowels": _share("[aeiouyAEIOUY]", token),
        "covered": _share("|".join(sorted(set(DICTIONARY), key=lambda w: (-len(w), w))), low),
        "announced": _has(ANNOUNCING, before),
        "assigned": before.rlike("[=:]\\s*[\"'`(\\[]?$").cast("double"),
        "named": before.rlike(f"{_NAMED}$").cast("double"),
        "known_form": token.rlike(KNOWN_FORMS).cast("double"),
        "quoted": before.rlike("[\"'`]$").cast("double"),
        "harmless": _has(HARMLESS, before),
        "made_up": _has(MADE_UP, around),
        "letters_before": F.when(F.length(before) > 0, _share("[A-Za-z]", before)).otherwise(0),
        "path_depth": F.size(F.split("path", "/")) - 1,
        "path_tests": _has("test|example|sample|fixture|doc", F.col("path")),
        "path_settings": _has("\\.(env|conf|cfg|ini|ya?ml|json|toml|properties|pem|key)$|config|secret", F.col("path")),
    }
    return found.withColumns({name: values[name].cast("double") for name in FEATURES})


#: What findings are made of. Names that a secret is assigned to, how, and what stands around.
_NAMES = (
    "token,api_key,API_KEY,secret,SECRET_KEY,password,passwd,db_password,DB_PASSWORD,access_token,auth_token,client_secret,private_key,"
    "credential,github_token,PWD,apikey,signature,TOKEN,user.password").split(",")
_STYLES = [' = "', "=", ": ", ': "', '="', "='", ' => "', '": "', '":"', " := '", " = ", " == \""]
_BEFORE = ["some text before ", "the config says ", "export ", "set ", "- ", '{"', "see https://www.example.org/page?id=4&", "in the log ", "", "# ", "and then "]
_AFTER = ['" and after it', "", " next", " in the log", '",', "' then", "&x=1 there", ";", " words follow"]
_PROSE = ["the word ", "see the ", "found ", "and ", "with a ", "push with ", "", "it says ", "in ", "about the "]
#: Words announcing what only looks like a secret, and values that nobody means.
_LOOK_ALIKES = [
    "commit ", "commit: ", "commit=", "sha1 ", "sha1: ", "SHA-256 ", "sha256=", "checksum ", "checksum: ", "md5 ", "md5=", "digest = ", "revision ",
    "hash = ", "hash: ", "version ", "image ", "file "]
_IDENTIFIERS = ["id ", "id=", "uuid=", "request ", 'guid: "', "session id ", "trace: ", ""]
_NUMBERS = ["card ", "call ", "phone ", "isbn ", "order no. ", "account: ", "number ", "on ", "at ", "page "]
_NOBODYS = [
    "example1234567890abcdef", "your_token_goes_here", "changeme", "xxxxxxxxxxxxxxxxxxxx", "REDACTED-REDACTED", "dummy-value-0001", "test1234",
    "placeholder_value_here", "your-api-key-123456", "sample0123456789sample", "00000000000000000000", "fakefakefake1234"]
_WORDS = ["required", "string", "value", "optional", "the_users_own", "getAuthToken", "os.environ", "mustBeAtLeast", "hidden", "never", "none", "expired",
          "validated", "of_the_matter", "incorrect", "forgotten"]
_OPAQUE = ["data:image/png;base64,", "https://cdn.example.org/a/", "cache-", "the blob ", "looks like ", "etag ", "/static/", "path/to/", "x", "font:"]


def made_findings(spark, per_kind: int = 600) -> DataFrame:
    """Findings of a known nature: `token`, `before`, `after`, `path` and `label`, `per_kind` texts of each kind.

    Secrets: hexadecimal, base64 and short mixed values assigned to names, bearer headers, and keys of issuers' forms with or without a
    name. No secrets: hashes of commits and files, identifiers, long words, card and telephone numbers, placeholders and words
    assigned to the same names, and opaque runs that nothing announces. Values come from digests, texts from lists, so the same
    findings are made each time; candidates and neighbours are taken from the texts as from any other.
    """
    def pick(values: Sequence[str], salt: int) -> Column:
        return F.element_at(F.array(*map(F.lit, values)), F.pmod(F.xxhash64("id", "kind", F.lit(salt)), F.lit(len(values))).cast("int") + 1)

    digest = lambda n: F.sha2(F.concat_ws(":", "kind", "id", F.lit(n)), 256)
    length = lambda least, most: F.pmod(F.xxhash64("id", "kind", F.lit(99)), F.lit(most - least + 1)).cast("int") + least
    cut = lambda of, least, most: F.substring(of, F.lit(1), length(least, most))
    start = lambda of, n: F.substring(of, 1, n)
    kinds = [
        (1, "named", F.col("hexadecimal")), (1, "named", cut("mixed", 16, 60)), (1, "named", cut("raw", 20, 44)),
        (1, "named", F.concat(cut("low", 4, 11), start("decimal", 2))), (1, "bearer", cut("mixed", 30, 60)), (1, "prose", F.col("form")),
        (1, "named", F.col("form")), (0, "alike", F.col("hexadecimal")), (0, "identified", F.col("uuid")), (0, "prose", F.col("long_word")),
        (0, "assigned", F.col("part")), (0, "numbered", start("decimal", 16)), (0, "named", F.col("nobodys")), (0, "named", F.col("word")),
        (0, "opaque", F.col("hexadecimal")), (0, "opaque", cut("raw", 20, 44))]
    base = spark.range(per_kind * len(kinds)).select((F.col("id") % per_kind).alias("id"), F.floor(F.col("id") / per_kind).cast("int").alias("kind"))
    values = base.select(
        "id", "kind", digest(1).alias("digest"), F.translate(F.concat(F.base64(F.unhex(digest(1))), F.base64(F.unhex(digest(2)))), "+/=\r\n", "xY").alias("mixed"),
        F.translate(F.base64(F.unhex(digest(3))), "\r\n", "").alias("raw"), F.translate(F.concat(digest(4), digest(5)), "abcdef", "").alias("decimal"),
        F.concat_ws("-", *(F.substring(digest(6), a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12)))).alias("uuid"),
        F.array(*(pick(DICTIONARY, s) for s in range(20, 25))).alias("parts"), pick(DICTIONARY, 9).alias("part"), pick(_NOBODYS, 4).alias("nobodys"),
        pick(_WORDS, 4).alias("word"), pick(_BEFORE, 1).alias("lead"), pick(_NAMES, 2).alias("name"), pick(_STYLES, 3).alias("style"),
        pick(_PROSE, 1).alias("prose"), pick(_LOOK_ALIKES, 2).alias("alike"), pick(_IDENTIFIERS, 2).alias("identified"), pick(_NUMBERS, 2).alias("numbered"),
        pick(_OPAQUE, 2).alias("opaque"), pick(["=", ": ", " = "], 2).alias("sign"), pick(_AFTER, 5).alias("rest"),
        pick(["src/a.py", "conf/app.env", "docs/x.md", "", "tests/b.json"], 6).alias("source"))
    values = settle(values, "made-values")
    form = F.element_at(F.array(
        F.concat(F.lit("AKIA"), start(F.upper("mixed"), 16)), F.concat(F.lit("ghp_"), start("mixed", 36)),
        F.concat(F.lit("xoxb-1"), start("decimal", 10), F.lit("-"), start("mixed", 24)), F.concat(F.lit("sk-7"), start("mixed", 40)),
        F.concat(F.lit("AIza"), start("mixed", 35)), F.concat(F.lit("sk_live_"), start("mixed", 24))), F.pmod(F.xxhash64("id", F.lit(7)), F.lit(6)).cast("int") + 1)
    values = values.withColumns({
        "hexadecimal": F.element_at(F.array(F.col("digest"), start("digest", 40), start("digest", 32)), F.pmod("id", F.lit(3)).cast("int") + 1),
        "low": F.lower("mixed"), "form": form, "named": F.concat("lead", "name", "style"), "bearer": F.concat("lead", F.lit("Authorization: Bearer ")),
        "long_word": F.when(F.col("id") % 2 == 0, F.array_join("parts", "")).otherwise(F.array_join(F.slice("parts", 1, 4), "_"))})
    values = values.withColumn("assigned", F.concat("prose", "long_word", "sign")).withColumns(
        {name: F.concat("prose", name) for name in ("alike", "identified", "numbered", "opaque")})
    of = lambda index, made: F.element_at(F.array(*(made(k[index]) for k in kinds)), F.col("kind") + 1)
    texts = values.select("id", "kind", of(0, F.lit).alias("label"), of(1, F.col).alias("lead"), of(2, lambda c: c).alias("value"), "rest", "source")
    texts = settle(texts.withColumn("text", F.concat("lead", "value", "rest")), "made-texts")
    found = candidates(texts, ("id", "kind", "label", "value"))
    return found.where("startswith(value, token) or startswith(token, value)").select("token", "before", "after", "path", "label")


@dataclass
class Scanner:
    """A fitted forest, or where the sample had one class only, that class's share."""

    forest: RandomForestClassificationModel | None
    share: float

    def judge(self, featured: DataFrame) -> DataFrame:
        """`featured` with `probability` that a candidate is a secret."""
        if self.forest is None:
            return featured.withColumn("probability", F.lit(self.share))
        vector = VectorAssembler(inputCols=list(FEATURES), outputCol="__features").transform(featured)
        judged = self.forest.transform(vector)
        return judged.withColumn("probability", vector_to_array("__probability")[1]).drop("__features", "__raw", "__probability", "__class")


#: What a row of the sample needs.
_SAMPLED = ("token", "before", "after", "label", *FEATURES)


def train(labelled: DataFrame, per_class: int = 6000, trees: int = 40, depth: int = 9, seed: int = 5) -> Scanner:
    """Fit on at most `per_class` findings of each label, taken in the order of a hash; rows with a NULL label are left out.

    `labelled` has FEATURES and `label`. The sample is written as one sorted file, so that the forest does not depend on
    how the findings are partitioned.
    """
    order = F.xxhash64("token", "before", "after")
    parts = [labelled.where(F.col("label") == y).orderBy(order, "token", "before", "after").limit(per_class) for y in (0, 1)]
    sample = settle(parts[0].unionAll(parts[1]).select(F.col("label").cast("double").alias("label"), *FEATURES).coalesce(1), "findings")
    counts = dict(sample.groupBy("label").count().collect())
    if len(counts) < 2:
        return Scanner(None, float(next(iter(counts), 0.0)))
    vector = VectorAssembler(inputCols=list(FEATURES), outputCol="__features").transform(sample)
    forest = RandomForestClassifier(
        featuresCol="__features", labelCol="label", probabilityCol="__probability", rawPredictionCol="__raw", predictionCol="__class",
        numTrees=trees, maxDepth=depth, seed=seed).fit(vector)
    return Scanner(forest, 0.0)


def scan(
    df: DataFrame, key: str = "doc_id", text: str = "text", path: str = "source", threshold: float = 0.5, per_class: int = 6000,
    carry: Sequence[str] = (), reviewed: DataFrame | None = None,
) -> DataFrame:
    """A row per candidate: key, carry, word_no, token_no, token, probability and is_secret.

    Candidates and their features are stored once, a narrow table, and read for the two classes of the sample and for
    judging. The forest learns from labelled findings (`token`, `before`, `after`, `path`, `label` 0 or 1): reviewed ones of the
    user's, or `made_findings`. To these come up to a quarter of `per_class` candidates of the training part of the ids that nothing
    announces and no issuer's form fits, as what the texts hold besides secrets. The forest alone judges every candidate of
    every whole text. NULL and empty texts have no candidates; rows without a key are judged and not learnt
    from; repeated rows give repeated findings; ties in the sample go by token and neighbours; a table without
    candidates gives no rows; other columns are not read.
    """
    featured = settle(with_features(candidates(df, [key, *carry], text, path)), "candidates")
    labelled = with_features(made_findings(df.sparkSession) if reviewed is None else reviewed).select(*_SAMPLED)
    order = F.xxhash64("token", "before", "after")
    plain = featured.where(in_training(F.col(key)) & F.expr("announced = 0 and assigned = 0 and known_form = 0"))
    plain = plain.orderBy(order, "token", "before", "after").limit(per_class // 4).withColumn("label", F.lit(0)).select(*_SAMPLED)
    judged = train(labelled.unionByName(plain), per_class).judge(featured)
    return judged.select(
        key, *carry, "word_no", "token_no", "token", "probability", (F.col("probability") >= threshold).alias("is_secret"))


def redact(
    df: DataFrame, key: str = "doc_id", text: str = "text", path: str = "source", mark: str = "[SECRET]", least: int = 16,
) -> DataFrame:
    """The rows of `df` with each confirmed secret in `text` replaced by `mark`; all other columns and rows as they are.

    The longest secrets are replaced first, those under `least` characters only where they stand alone. Confirmed secrets are few and meet their documents by key and a hash of the
    text, so a row without a key, or with a repeated one, gets its own.
    """
    place = [f"`{key}`", f"`{text}`"]
    hashed = df.select(F.col(f"`{key}`"), F.col(f"`{text}`"), *([F.col(f"`{path}`")] if path in df.columns else []),
                       F.xxhash64(*place).alias("__h"))
    found = scan(hashed, key, text, path, carry=("__h",)).where("is_secret")
    secrets = found.groupBy(F.col("__h").alias("__s")).agg(
        F.array_sort(F.collect_set(F.struct((-F.length("token")).alias("n"), "token"))).alias("__secrets"))
    joined = df.withColumn("__h", F.xxhash64(*place)).join(settle(secrets, "secrets"), F.col("__h") == F.col("__s"), "left")
    alone = lambda s: F.concat(
        F.lit(f"(?<!{_PLAIN})"), F.regexp_replace(s.token, "([+\\\\])", "\\\\$1"), F.lit(f"(?!{_TOKEN})"))
    literal = F.lit(mark.replace("\\", "\\\\").replace("$", "\\$"))
    clean = F.aggregate("__secrets", F.col(f"`{text}`").cast("string"), lambda t, s: F.when(
        F.length(s.token) >= least, F.replace(t, s.token, F.lit(mark))).otherwise(F.regexp_replace(t, alone(s), literal)))
    return joined.withColumn(text, F.when(F.col("__secrets").isNotNull(), clean).otherwise(F.col(f"`{text}`"))).select(
        *(F.col(f"`{c}`") for c in df.columns))

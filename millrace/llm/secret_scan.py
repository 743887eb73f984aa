"""Secret scans: wide candidate patterns, and a random forest that removes false positives.

A candidate is a long run of key characters, a token of three dotted parts, the body of a
private key, the password in a URL, or the value that a name announces: by a sign, as a
flag, as a tag or after a blank, whatever its length and characters; or any other assigned
value. The forest sees its length, its character transitions, how far words of the corpus
cover it, whether it looks like a path, and the words beside it. It is trained on labelled
findings and runs as a column expression. DataFrame functions only; training takes a bounded
sample of findings to the driver.

The label of a finding comes from a format of known providers or from its announcement. So
that the forest does not learn the announcement alone, announced values and words also
teach without it: as values after a name and a blank, where only their form tells.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm import trees
from millrace.llm.common import bounded_sample, written

CONTEXT = 32
#: Names that announce a secret.
NAMES = (r"password|passwd|pwd|secret|token|api[_\- ]?key|access[_\- ]?key|auth|authorization|"
         r"credential|private[_\- ]?key|secret[_\- ]?key")
#: The last two letters of those names: a quick look before the names are tried.
_LAST = r"rd|wd|et|en|ey|th|on|al"
_SIGN = r"(?::=|=>|==?|:)"
#: What announces a value for certain: a name and a sign, a flag or a tag with the name, the
#: user before a password in a URL, or the head of a private key.
ANNOUNCED = (rf"(?i)(?:(?:{NAMES})[\"'`]?\s*{_SIGN}\s*(?:(?:bearer|basic)\s)?[\"'`]?"
             rf"|(?:^|\s)--?[\w\-]*(?:{NAMES})\s[\"'`]?|<[\w:.\-]*(?:{NAMES})(?:\s[^<>]*)?>"
             r"|://[^\s:/@]*:|PRIVATE KEY(?: BLOCK)?-----\s*)$")
#: What may announce one: a name and a blank, as in prose.
NAMED = rf"(?i)(?:(?:{NAMES})[\"'`]?\s(?:(?:is|was):?\s)?[\"'`]?|bearer\s)$"
_KEY = r"[A-Za-z0-9+/_\-]"
#: A candidate: at least 16 key characters in a row.
RUN = _KEY + r"{16,}={0,2}"
#: A candidate: a signed token of dotted parts; its first begins as encoded JSON does.
DOTTED = r"eyJ[A-Za-z0-9_\-]{8,}+\.[A-Za-z0-9_\-]++(?:\.[A-Za-z0-9_\-]*+)?+"
#: Between a name and its value, the opening quote left out.
_GIVES = rf"[\"'`]?[ \t]*+{_SIGN}[ \t]*+"
_SCHEME = r"(?:(?i:bearer|basic)[ \t]++)?+"
_BLANK = r"[\"'`]?(?:[ \t]++(?i:is|was):?[ \t]++|[ \t]++)"
#: A candidate: the value after an announcing name, up to its closing quote, or to a blank
#: or quote and without closing punctuation.
_QUOTED = "|".join(rf"{q}(?!{q})[^{q}\\\r\n]*+(?:\\.[^{q}\\\r\n]*+)*+(?={q})"
                   for q in "\"'`")
_END = r"(?=[\s\"'`,;.)\]}]|$)"
_OPEN = (rf"[\"'`]?(?:(?:\$\{{[^}}\s]*\}}|\{{\{{[^}}\s]*\}}\}}|\$\([^)\s]*\)){_END}"
         r"|[^\s\"'`]*[^\s\"'`,;.)\]}])")
#: After a blank: with a letter or digit, and no name of another value.
_LOOSE = (rf"(?=[^\s\"'`]*?[\p{{L}}0-9])(?!{_KEY}++[\"'`]?[ \t]*+[:=])"
          rf"(?!-{{0,2}}(?i:{NAMES})[\"'`]?[ \t]*+\S){_OPEN}")
_ANNOUNCED_VALUE = (rf"{_KEY}++(?<=(?i:{_LAST}))(?<=(?i:{NAMES}))(?:"
                    rf"{_GIVES}(?:{_QUOTED}|{_SCHEME}{_OPEN})|{_BLANK}(?:{_QUOTED}|{_LOOSE}))")
#: A candidate: what is assigned to any other name that is not a run with digits itself. It holds
#: no further assignment, so that an announced value inside is found by its own name.
_ASSIGNED_VALUE = (rf"(?:[A-Za-z_\-]++|{_KEY}{{1,15}}+)(?!{_KEY})(?:{_GIVES}(?:"
                   + "|".join(rf"{q}[^{q}\s:=]++(?={q})" for q in "\"'`")
                   + r")|[\"'`]?[ \t]*+(?::?=)[ \t]*+[^\s\"'`:=]++(?![:=]))")
#: A candidate: the password of a URL's user.
_USER = r"://[^\s:/@]*+:"
_PASSWORD = r"[^\s/\"'`<>@]++(?:@[^\s/\"'`<>@]++(?=@))*+(?=@)"
#: A candidate: the body of a private key, up to its end mark, or its lines where none follows.
_HEAD = r"-----BEGIN [A-Z0-9 ]*PRIVATE KEY(?: BLOCK)?-----\s*+"
_BODY = r"(?:[^\-]++(?:-(?!----)[^\-]*+)*+(?=-----END)|(?:[A-Za-z0-9+/]{16,}+={0,2}\s*+)++)"
#: A candidate: the content of a tag with an announcing name.
_TAG = rf"<[\w:.\-]*(?i:{NAMES})(?:\s[^<>]*+)?>"
_BEARER = r"Bearer[ \t]++"
CANDIDATE = (rf"{_USER}{_PASSWORD}|(?<!{_KEY})(?:{_HEAD}{_BODY}|{_TAG}[^<>]++(?=<)"
             rf"|{_ANNOUNCED_VALUE}|{_BEARER}[A-Za-z0-9._~+/\-]++={{0,2}}"
             rf"|{_ASSIGNED_VALUE}|{DOTTED}|{RUN})")
#: The name, sign and quote that a candidate begins with; a run has none.
_LEAD = (rf"(?s)^(?:{_HEAD}|{_USER}|<[^<>]*+>|{_BEARER}"
         rf"|{_KEY}++(?:{_GIVES}{_SCHEME}|{_BLANK})[\"'`]?)(?=.)")
#: What stands for a value, or says that there is none.
PLACEHOLDERS = (r"(?i)^(true|false|none|null|nil|undefined|\*+|<[^>]*>|\$\{[^}]*\}|"
                r"\$\([^)]*\)|\{\{.*\}\})$")
WORDS = r"^[\p{L}_\-]+$"
#: Formats that look random and are no secrets unless announced.
UUID = r"^[0-9A-Fa-f]{8}(-[0-9A-Fa-f]{4}){3}-[0-9A-Fa-f]{12}$"
HASH = r"^(([0-9a-f]{32}|[0-9A-F]{32})([0-9A-Fa-f]{8}|[0-9A-Fa-f]{32}|[0-9A-Fa-f]{96})?)$"
PATH = r"^/?([a-z0-9_.\-]+/)+[a-z0-9_.\-]*$"
#: Formats of well-known providers.
PROVIDERS = (r"^((AKIA|ASIA)[0-9A-Z]{16}|gh[pousr]_[A-Za-z0-9]{36}|xox[abprs]-[A-Za-z0-9\-]{10,}|"
             rf"{DOTTED})$")
REDACTED = "[SECRET]"
FOUND = "_secret_candidates"

FEATURES = ("length", "digits", "uppers", "hexadecimal", "transitions", "distinct", "vowels",
            "covered", "path", "announced", "quoted", "assigned", "sentence", "marks", "uuid",
            "named")


@dataclass(frozen=True)
class SecretModel:
    """A forest, and the corpus words whose cover it measures.

    Without labelled findings of both kinds there is no forest; the label rules
    decide then.
    """

    words: tuple[str, ...] = ()
    forest: tuple = field(default=())
    threshold: float = 0.5


def candidates(text: Column) -> Column:
    """Array of (token, before, after, lead), in order. NULL for a NULL text.

    ``lead`` is the name, sign and quote that were found with the value, empty for a
    run; the texts between candidates end before it.
    """
    gaps = F.split(text, CANDIDATE, -1)
    runs = F.regexp_extract_all(text, F.lit(CANDIDATE), F.lit(0))
    # One cell, so that both arrays are made once and not once per candidate.
    cell = F.array(F.struct(runs.alias("runs"), gaps.alias("gaps")))

    def parts(s):
        whole = F.transform(s["runs"], lambda run: F.struct(
            run.alias("run"), F.when(run.rlike(rf"\A(?:{DOTTED}|{RUN})\z"), F.lit("")).otherwise(
                F.regexp_extract(run, _LEAD, 0)).alias("lead")))
        return F.transform(whole, lambda r, i: F.struct(
            F.substring(r["run"], F.length(r["lead"]) + 1, F.length(r["run"])).alias("token"),
            F.right(F.concat(F.get(s["gaps"], i), F.regexp_replace(r["lead"], r"\s+", " ")),
                    F.greatest(F.lit(CONTEXT), F.length(r["lead"]))).alias("before"),
            F.left(F.get(s["gaps"], i + 1), F.lit(CONTEXT)).alias("after"),
            r["lead"].alias("lead")))

    return F.transform(cell, parts)[0]


def _share(part: Column, whole: Column) -> Column:
    return part / F.greatest(whole, F.lit(1))


def features(token: Column, before: Column, after: Column, words: tuple[str, ...]) -> Column:
    """Struct of ``FEATURES``, all double."""
    size = F.length(token)
    count = lambda pattern: F.regexp_count(token, F.lit(pattern))
    kinds = F.regexp_replace(F.regexp_replace(F.regexp_replace(
        token, "[a-z]", "a"), "[A-Z]", "B"), "[0-9]", "0")
    flag = lambda condition: F.when(condition, 1.0).otherwise(0.0)
    lower = F.lower(token)
    rest = F.regexp_replace(lower, "|".join(words), "") if words else lower
    made = {
        "length": size, "digits": _share(count("[0-9]"), size),
        "uppers": _share(count("[A-Z]"), size),
        "hexadecimal": flag(token.rlike("^([0-9a-f]+|[0-9A-F]+)$")),
        "transitions": _share(F.length(F.regexp_replace(kinds, r"(.)\1+", "$1")) - 1, size),
        "distinct": _share(F.size(F.array_distinct(F.split(lower, ""))), size),
        "vowels": _share(count("[aeiouAEIOU]"), size),
        "covered": _share(size - F.length(rest), size),
        "path": flag(token.contains("/") | before.rlike(r"[/.@\\]$") | after.rlike(r"^[.@/]\w")),
        "announced": flag(before.rlike(ANNOUNCED)),
        "quoted": flag(before.rlike("[\"'`]$")),
        "assigned": flag(before.rlike(r"[:=]>?\s*[\"'`]?$")),
        "sentence": flag(before.rlike(r"\p{L}[,.]?\s$") & after.rlike(r"^[,.]?\s+\p{L}")),
        "marks": _share(count(r"[^\p{L}\p{N}\s]"), size),
        "uuid": flag(token.rlike(UUID)),
        "named": flag(before.rlike(NAMED) & ~before.rlike(ANNOUNCED)),
    }
    return F.struct(*(made[name].cast("double").alias(name) for name in FEATURES))


def weak_label(token: Column, before: Column) -> Column:
    """1 for findings in a provider's format or announced, 0 for placeholders, and for words,
    numbers, hashes, UUIDs and paths that nothing announces; NULL where the rules cannot
    tell. A hash that is given to a key of any name may be a secret, and so may what
    follows an announcing name and a blank, unless it is a word."""
    announced = before.rlike(ANNOUNCED)
    keyed = before.rlike(rf"(?i)key[\"'`]?\s*{_SIGN}\s*[\"'`]?$") | before.rlike(NAMED)
    return (F.when(token.rlike(PROVIDERS), 1)
            .when(announced, F.when(token.rlike(PLACEHOLDERS), 0).otherwise(1))
            .when(token.rlike(WORDS) | token.rlike(UUID) | token.rlike(PATH)
                  | (token.rlike(rf"^[0-9]+$|{HASH}") & ~keyed), 0))


def common_words(docs: DataFrame, most: int = 400) -> tuple[str, ...]:
    """The most frequent words of 3 to 8 small letters over all texts, at most ``most``."""
    counted = written(docs.select(F.explode(F.regexp_extract_all(
        "text", F.lit(r"(?<![A-Za-z])([a-z]{3,8})(?![A-Za-z])"), F.lit(1))).alias("word")
    ).groupBy("word").agg(F.count(F.lit(1)).alias("n")), "secret-words")
    # The steps of counts (a sixty-fourth of an octave) tell what to leave out before the rest
    # is ranked: all tasks together send about ``most`` rows.
    step, cut, held = F.floor(F.log2("n") * 64), None, 0
    for row in sorted(counted.groupBy(step.alias("step")).count().collect(), reverse=True):
        cut, held = row["step"], held + row["count"]
        if held >= most:
            break
    top = counted.where(step >= cut if cut is not None else F.lit(False)).orderBy(
        F.desc("n"), "word").limit(most).collect()
    return tuple(sorted((r["word"] for r in top), key=lambda w: (-len(w), w)))


def find(docs: DataFrame) -> DataFrame:
    """``docs`` with its candidates in a column ``_secret_candidates``, for :func:`scan`,
    :func:`redact` and :func:`fit`; write it, and the patterns run once for all of them."""
    return docs.withColumn(FOUND, candidates(F.col("text")))


def _with_candidates(docs: DataFrame) -> DataFrame:
    return docs if FOUND in docs.columns else find(docs)


def labelled_findings(docs: DataFrame) -> DataFrame:
    """Findings of ``docs`` that the label rules can tell: token, before, after, label."""
    return _with_candidates(docs).select(F.explode(FOUND).alias("c")).select(
        "c.token", "c.before", "c.after").withColumn(
        "label", weak_label(F.col("token"), F.col("before"))).where("label IS NOT NULL")


def training_rows(findings: DataFrame, words: tuple[str, ...], most_findings: int
                  ) -> tuple[np.ndarray, np.ndarray]:
    """Features and labels of at most ``most_findings`` findings of each label, each different
    finding once, chosen by hash; and again those that are announced, and words, as values
    that only follow a name and a blank."""
    context = [F.coalesce(c, F.lit("")) for c in ("before", "after")]
    rows = []
    for label in (0, 1):
        distinct = findings.where(F.col("label") == label).select(
            "token", "before", "after").distinct()
        sample = bounded_sample(distinct, most_findings, "token", "before", "after")
        rows += [(label, r["word"], *r["f"]) for r in sample.select(
            F.col("token").rlike(WORDS).alias("word"),
            features(F.col("token"), *context, words).alias("f")).collect()]
    table = np.array(rows, float).reshape(-1, len(FEATURES) + 2)
    labels, word, values = table[:, 0].astype(int), table[:, 1], table[:, 2:]
    at = FEATURES.index
    other = np.where(labels == 1, values[:, at("announced")] == 1, word == 1)
    bare = values[other]
    bare[:, [at("announced"), at("assigned"), at("quoted")]] = 0
    bare[:, at("named")] = 1
    return np.vstack([values, bare]), np.concatenate([labels, labels[other]])


def train(findings: DataFrame, words: tuple[str, ...], most_findings: int = 8000,
          count: int = 25, depth: int = 5, seed: int = 11) -> SecretModel:
    """A forest from labelled findings (token, before, after, label), see
    :func:`training_rows`."""
    values, labels = training_rows(findings, words, most_findings)
    if len(set(labels.tolist())) < 2:
        return SecretModel(words)
    return SecretModel(words, tuple(trees.forest(values, labels, count, depth, 2, seed)))


def _score(model: SecretModel, found: Column, label: Column) -> Column:
    """Mean vote of the trees over a struct of features."""
    if not model.forest:
        return F.coalesce(label, F.lit(0)).cast("double")
    columns = [found[name] for name in FEATURES]
    votes = [trees.as_column(t, columns) for t in model.forest]
    return sum(votes[1:], votes[0]) / F.lit(float(len(votes)))


def scan(docs: DataFrame, model: SecretModel) -> DataFrame:
    """One row per candidate: ``doc_id``, ``place`` (from 0), ``token_sha256``,
    ``length``, ``score`` and ``is_secret``.

    Texts that are NULL, empty or without candidates give no rows. Repeated
    rows give theirs again; NULL ids stay NULL.
    """
    found = _with_candidates(docs).select("doc_id", F.posexplode(FOUND).alias("place", "c"))
    measured = found.select(
        "doc_id", "place", F.sha2("c.token", 256).alias("token_sha256"),
        F.length("c.token").cast("bigint").alias("length"),
        weak_label(F.col("c.token"), F.col("c.before")).alias("label"),
        features(F.col("c.token"), F.col("c.before"), F.col("c.after"), model.words).alias("f"))
    scored = measured.withColumn("score", _score(model, F.col("f"), F.col("label")))
    return scored.select("doc_id", "place", "token_sha256", "length", "score",
                         (F.col("score") >= model.threshold).alias("is_secret"))


def redact(docs: DataFrame, model: SecretModel) -> DataFrame:
    """``docs`` with each secret in ``text`` replaced; ``n_chars`` follows where it is there.

    Works within the row: no join, so repeated and NULL ids need no care.
    """
    cells = F.transform(FOUND, lambda c: F.struct(
        c["lead"].alias("lead"), c["token"].alias("token"),
        weak_label(c["token"], c["before"]).alias("label"),
        features(c["token"], c["before"], c["after"], model.words).alias("f")))
    shown = F.transform("_secret_features", lambda c: F.struct(c["lead"].alias("lead"), F.when(
        _score(model, c["f"], c["label"]) >= model.threshold, REDACTED).otherwise(
        c["token"]).alias("token")))
    held = F.col("_secret_shown")
    gaps = F.split("text", CANDIDATE, -1)
    rebuilt = F.array_join(F.transform(gaps, lambda gap, i: F.concat(
        gap, F.coalesce(F.get(held, i)["lead"], F.lit("")),
        F.coalesce(F.get(held, i)["token"], F.lit("")))), "")
    changed = F.array_contains("_secret_shown.token", REDACTED)
    out = (
        _with_candidates(docs).withColumn("_secret_features", cells)
        .withColumn("_secret_shown", shown)
        .withColumn("text", F.when(changed, rebuilt).otherwise(F.col("text")))
    )
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(changed, F.length("text").cast("bigint"))
                             .otherwise(F.col("n_chars")))
    return out.select([c for c in docs.columns if c != FOUND])


def fit(docs: DataFrame, found: DataFrame | None = None) -> SecretModel:
    """A model from the texts themselves: their words, and the findings that the label
    rules can tell. ``found`` is the written result of :func:`find`, if there is one."""
    findings = labelled_findings(docs if found is None else found)
    return train(written(findings, "secret-findings"), common_words(docs))

"""Personal data by weak supervision (operator 3), with DataFrame functions only.

Candidate spans come from patterns. Four labelers vote on each, for, against or not at all: the shape of the match, a
gazetteer, the words before it, and its edges. Votes are counted by kind, vote pattern and length, a table of bounded
size; expectation-maximisation on it estimates how reliable each labeler is and how likely each pattern is personal data, and a
logistic span classifier is fitted to these likelihoods. Its weights become a column expression that is applied to
every candidate. Matches of the four base patterns that pass their checks are spans whatever the classifier says; it
adds others that overlap none of them.

Positions come from the lengths of the matches and of the texts between them, summed in blocks, so the work stays near
linear in the matches of a text. Patterns take each run of characters once (possessive, anchored at run starts or at the
end of the last match), so that long runs do not cost their square; the matches are those of the plain patterns.

Two scans of the texts, no shuffle but of counts.

Defined cases: null texts are empty and have no spans; positions are code points, ends exclusive; repeated rows are labelled
alike; an empty table fits a classifier that adds nothing; columns named like a result are replaced.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rankloom.llm.common import query, table

#: Kind, pattern, and a plain test that a text must pass before the pattern is tried. The first four are the base kinds.
PATTERNS = (
    ("email", r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", r"@"),
    ("ip", r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", r"[0-9]\.[0-9]"),
    ("card", r"[0-9](?:[\x20-]?[0-9])++", r"[0-9][\x20-]?[0-9]"),
    ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", r"\+[0-9]"),
    ("masked_email", r"(?<![A-Za-z0-9])[A-Za-z0-9._%+-]{1,64}\x20?[\[(]\x20?at\x20?[\])]\x20?[A-Za-z0-9-]{1,63}"
                     r"(?:(?:\x20?[\[(]\x20?dot\x20?[\])]\x20?|\.)[A-Za-z0-9-]{1,63}){1,8}", r"[\[(]\x20?at\x20?[\])]"),
    ("number", r"(?<![0-9A-Za-z.+-])[0-9]{3}[\x20.-][0-9]{2,3}[\x20.-][0-9]{4}(?![0-9A-Za-z])", r"[0-9]{3}[\x20.-][0-9]{2}"),
    ("secret", r"(?i)(?<![a-z0-9])(?:password|passwd|secret|token|api[_-]key|access[_-]key)\x20{0,3}[=:]\x20{0,3}[\"']?[a-z0-9+/_.-]{8,}+",
     r"[=:]"),
    ("name", r"(?<![A-Za-z])(?:Mr|Mrs|Ms|Dr|Herr|Frau|Mme|Señor|Señora)\.?\x20[A-Z][a-z]{1,30}(?:\x20[A-Z][a-z]{1,30})?",
     r"(?:Mr|Mrs|Ms|Dr|Herr|Frau|Mme|Señora?)\.?\x20[A-Z]"),
)
KINDS = tuple(p[0] for p in PATTERNS)
BASE = KINDS[:4]
LABELERS = ("shape", "gazetteer", "context", "edges")
#: Gazetteers: what a match of the kind usually has. Plain facts about the forms.
GAZETTEERS = {
    "email": r"\.(?:com|org|net|edu|gov|info|io|de|fr|es|uk|eu)$",
    "masked_email": r"(?:\.|dot[\])]?\x20?)(?:com|org|net|edu|gov|info|io|de|fr|es|uk|eu)$",
    "ip": r"^(?!0+\.|255\.255\.)",
    "card": r"^(?:4|5[1-5]|3[47]|6011|65)",
    "phone": r"^\+(?:1|7|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58])",
    "number": r"^[2-9]",
    "secret": r"[0-9]",
    "name": r"\x20(?:Anna|Ben|Carlos|Clara|David|Elena|Emma|Hans|Jean|John|Juan|Laura|Lucas|Maria|Marie|Max|Paul|Peter|Sara|Sophie)",
}
#: Words before a match that speak for each kind, and against any.
CONTEXT = {
    "email": r"e-?mail|mail|contact|correo|courriel|kontakt", "masked_email": r"e-?mail|mail|contact|correo|courriel|kontakt",
    "ip": r"ip|host|server|address|login", "card": r"card|visa|credit|karte|carte|tarjeta|account",
    "phone": r"phone|call|tel|mobile|fax|contact|telefon", "number": r"phone|call|tel|ssn|social|mobile|fax",
    "secret": r"user|login|key|config|export", "name": r"name|author|from|by|contact",
}
AGAINST = r"(?i)(?:order|isbn|version|invoice|ticket|serial|sku|ref|#)[\x20.:#]{0,3}$"
NEAR, BLOCK = 40, 128


def running_sum(steps: Column) -> Column:
    """Sums up to and with each entry of an array of ints, in two levels."""
    blocks = F.transform(F.sequence(F.lit(0), F.floor((F.size(steps) - 1) / BLOCK).cast("int")), lambda b: F.slice(steps, b * BLOCK + 1, BLOCK))
    inner = F.transform(blocks, lambda x: F.aggregate(x, F.array().cast("array<int>"), lambda a, v: F.concat(
        a, F.array(F.coalesce(F.try_element_at(a, F.lit(-1)), F.lit(0)) + v))))
    tops = F.aggregate(inner, F.array(F.lit(0)), lambda a, x: F.concat(a, F.array(F.element_at(a, -1) + F.element_at(x, -1))))
    with_tops = F.transform(F.arrays_zip(inner.alias("x"), F.slice(tops, 1, F.size(inner)).alias("t")),
                            lambda z: F.transform(z["x"], lambda v: v + z["t"]))
    return F.when(F.size(steps) > 0, F.flatten(with_tops)).otherwise(F.array().cast("array<int>"))


def end_steps(kind: str):
    """Function from a match and its number to its length with the text since the last match."""
    def step(m: Column, i: Column) -> Column:
        return F.length(m) + F.length(F.get(f" gaps {kind}", i))
    return step


def match_struct(kind: str):
    """Function from a match and its number to the match with its place and surroundings."""
    def described(m: Column, i: Column) -> Column:
        end = F.get(f" ends {kind}", i)
        return F.struct((end - F.length(m)).alias("s"), end.alias("e"), m.alias("m"),
                        F.right(F.get(f" gaps {kind}", i), F.lit(NEAR)).alias("before"),
                        F.left(F.get(f" gaps {kind}", i + 1), F.lit(2)).alias("after"))
    return described


def with_matches(df: DataFrame, text: str) -> DataFrame:
    """``df`` with an array of (s, e, m, before, after) for each kind, under the kind's name with a blank."""
    nothing = F.array().cast("array<string>")
    for kind, pattern, test in PATTERNS:
        may = F.col(text).rlike(test)
        df = df.withColumns({
            f" hits {kind}": F.when(may, F.regexp_extract_all(text, F.lit(pattern), F.lit(0))).otherwise(nothing),
            f" gaps {kind}": F.when(may, F.split(text, pattern, -1)).otherwise(nothing),
        }).withColumn(f" ends {kind}", running_sum(F.transform(f" hits {kind}", end_steps(kind))))
        df = df.withColumn(f" {kind}", F.transform(f" hits {kind}", match_struct(kind))).drop(f" hits {kind}", f" gaps {kind}", f" ends {kind}")
    return df


def digits(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]", "")


def luhn(number: Column) -> Column:
    """Whether digits, at most 19, pass the check sum."""
    def worth(i: Column) -> Column:
        d = F.substring(number, F.length(number) - i, F.lit(1)).cast("int") * (1 + i % 2)
        return d - F.when(d > 9, 9).otherwise(0)
    places = F.sequence(F.lit(0), F.length(number) - 1)
    return F.aggregate(F.transform(places, worth), F.lit(0), lambda a, d: a + d) % 10 == 0


def passes(kind: str, m: Column) -> Column:
    """The base kinds' checks; for others what their shape should be."""
    number = digits(m)
    if kind == "ip":
        return F.forall(F.split(m, r"\."), lambda p: F.when(F.length(F.regexp_replace(p, "^0+(?=.)", "")) > 3, False).otherwise(
            F.right(p, F.lit(3)).cast("int") <= 255))
    if kind == "card":
        return F.when(F.length(number).between(14, 19), luhn(number)).otherwise(False)
    if kind == "phone":
        return F.length(number).between(10, 15)
    if kind == "secret":
        return m.rlike("[=:][^0-9]*+[0-9]") & m.rlike("[=:][^A-Za-z]*+[A-Za-z]")
    return F.lit(True)


def votes(kind: str, c: Column) -> dict[str, Column]:
    """1, -1 or 0 of each labeler on a candidate."""
    def vote(yes: Column, no: Column) -> Column:
        return F.when(yes, 1).when(no, -1).otherwise(0)
    ok, joined = passes(kind, c["m"]), c["before"].rlike("[A-Za-z0-9]$") | c["after"].rlike("^[A-Za-z0-9]")
    return {
        "shape": vote(ok, ~ok),
        "gazetteer": vote(c["m"].rlike(GAZETTEERS[kind]), F.lit(kind in ("card", "phone", "ip"))),
        "context": vote(c["before"].rlike(rf"(?i)(?<![a-z])(?:{CONTEXT[kind]})[^a-z]{{0,6}}$"), c["before"].rlike(AGAINST)),
        "edges": vote(~joined, joined),
    }


def voted(kind: str, n: int):
    """Function from a match to a candidate."""
    def candidate(c: Column) -> Column:
        return F.struct(c["s"].alias("s"), F.lit(n).alias("n"), c["e"].alias("e"), F.lit(kind).alias("kind"),
                        *[v.cast("int").alias(name) for name, v in votes(kind, c).items()],
                        F.least((c["e"] - c["s"]) / 4, F.lit(10)).cast("int").alias("size"))
    return candidate


def with_candidates(docs: DataFrame, text: str) -> DataFrame:
    """``docs`` with arrays `` base`` and `` other`` of candidates (s, n: kind's number, e, kind, votes, size)."""
    df = with_matches(docs, text)
    pools: dict[str, list[Column]] = {" base": [], " other": []}
    for n, kind in enumerate(KINDS):
        judged = F.transform(f" {kind}", voted(kind, n))
        if kind in BASE:
            pools[" base"].append(F.filter(judged, lambda c: c["shape"] == 1))
            judged = F.filter(judged, lambda c: c["shape"] != 1)
        pools[" other"].append(judged)
    df = df.withColumns({name: F.concat(*arrays) for name, arrays in pools.items()})
    return df.drop(*[f" {k}" for k in KINDS])


class SpanClassifier:
    """Weights of a logistic function: one per kind, one per labeler, one for the size."""

    def __init__(self, patterns: list[tuple]) -> None:
        """``patterns``: (kind's number, votes of the labelers, size, count)."""
        self.weights = np.zeros(len(KINDS) + len(LABELERS) + 1)
        self.accuracy: dict[str, float] = {}
        if not patterns:
            return
        kind = np.array([p[0] for p in patterns])
        vote = np.array([p[1] for p in patterns])
        size = np.array([p[2] for p in patterns], float)
        n = np.array([p[3] for p in patterns], float)
        good = self._posterior(kind, vote, n)
        self.accuracy = {name: float((n * np.where(v > 0, good, 1 - good))[v != 0].sum() / max(n[v != 0].sum(), 1))
                         for name, v in zip(LABELERS, vote.T, strict=True)}
        design = np.column_stack([np.eye(len(KINDS))[kind], vote, size / 10])
        share = n / n.sum() * min(n.sum(), 10_000)
        for _ in range(50):
            p = 1 / (1 + np.exp(-np.clip(design @ self.weights, -30, 30)))
            grad = design.T @ (share * (good - p)) - 0.1 * self.weights
            curve = (design * (share * p * (1 - p))[:, None]).T @ design + 0.1 * np.eye(len(self.weights))
            self.weights = self.weights + np.linalg.solve(curve, grad)

    @staticmethod
    def _posterior(kind: np.ndarray, vote: np.ndarray, n: np.ndarray, rounds: int = 30) -> np.ndarray:
        """Likelihood that each pattern is personal data, by expectation-maximisation over labeler reliabilities."""
        good = np.clip(0.5 + vote.mean(axis=1) / 2, 0.05, 0.95)
        for _ in range(rounds):
            logs = np.zeros((2, len(n)))
            for y, part in enumerate((1 - good, good)):
                held = np.bincount(kind, n * part, len(KINDS)) + 1.0
                logs[y] = np.log(held / (np.bincount(kind, n, len(KINDS)) + 2.0))[kind]
                for v in vote.T:
                    said = np.array([(n * part)[v == x].sum() + (2.0 if x == (1 if y else -1) else 1.0) for x in (-1, 0, 1)])
                    logs[y] += np.log(said / said.sum())[v + 1]
            good = 1 / (1 + np.exp(np.clip(logs[0] - logs[1], -30, 30)))
        return good

    def accepts(self, c: Column) -> Column:
        """Whether a candidate's probability is above one half."""
        w = [float(x) for x in self.weights]
        total = F.element_at(F.array(*[F.lit(x) for x in w[:len(KINDS)]]), c["n"] + 1)
        for name, x in zip(LABELERS, w[len(KINDS):], strict=False):
            total = total + c[name] * x
        return total + c["size"] / 10 * w[-1] > 0


def fit(docs: DataFrame, text: str = "text") -> SpanClassifier:
    rows = with_candidates(docs.select(F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text")), "text")
    counts = rows.select(F.explode(F.concat(" base", " other")).alias("c")).groupBy(
        *[F.col(f"c.{x}").alias(x) for x in ("n", *LABELERS, "size")]).count().collect()
    return SpanClassifier(sorted((r["n"], tuple(r[x] for x in LABELERS), r["size"], r["count"]) for r in counts))


def label(docs: DataFrame, classifier: SpanClassifier, text: str = "text") -> DataFrame:
    """``docs`` with base and spans, arrays of (s, n, e, kind) by start, then kind; the latter with added spans."""
    kept = [c for c in docs.columns if c not in ("base", "spans")]
    df = with_candidates(docs.withColumn(" text", F.coalesce(F.col(text).cast("string"), F.lit(""))), " text")
    slim = lambda pool: F.array_sort(F.transform(pool, lambda c: F.struct(c["s"], c["n"], c["e"], c["kind"])))
    free = lambda c: ~F.exists(" base", lambda b: (b["s"] < c["e"]) & (c["s"] < b["e"]))
    added = F.filter(" other", lambda c: classifier.accepts(c) & free(c))
    return df.select(*[f"`{c}`" for c in kept], slim(F.col(" base")).alias("base"), slim(F.concat(F.col(" base"), added)).alias("spans"))


def written(spans: str) -> Column:
    """kind:start:end, comma-joined."""
    return F.array_join(F.transform(spans, lambda c: F.concat_ws(":", c["kind"], c["s"].cast("string"), c["e"].cast("string"))), ",")


def redacted(text: str, spans: str) -> Column:
    """The text with each span replaced by its kind in brackets; of overlapping spans the first one names the cut."""
    start = F.struct(F.array().cast("array<string>").alias("out"), F.lit(0).alias("at"))
    done = F.aggregate(spans, start, lambda a, c: F.when(c["s"] >= a["at"], F.struct(
        F.concat(a["out"], F.array(F.substring(text, a["at"] + 1, c["s"] - a["at"]), F.concat(F.lit("["), F.upper(c["kind"]), F.lit("]")))).alias("out"),
        c["e"].alias("at"))).otherwise(F.struct(a["out"].alias("out"), F.greatest(a["at"], c["e"]).alias("at"))))
    return F.when(F.size(spans) == 0, F.col(text)).otherwise(
        F.concat(F.array_join(done["out"], ""), F.substring(text, done["at"] + 1, F.length(text) - done["at"])))


@query("op3_personal_data")
def op3(spark, sf_dir):
    """Personal data in every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = label(docs, fit(docs))
    count = lambda n: F.size(F.filter("base", lambda c: c["n"] == n)).cast("long")
    return found.select("doc_id", *[count(n).alias(f"n_{k}") for n, k in enumerate(BASE)],
                        F.sha2(written("base").cast("binary"), 256).alias("base_sha256"), written("spans").alias("spans"))

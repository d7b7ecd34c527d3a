"""Personal data by weak supervision, with DataFrame functions only (operator 2).

Base patterns give spans that always stay.  Their failed matches and looser patterns propose further candidates.
Labelers of shape, checksum, gazetteer, cue words and neighbouring words vote on every candidate; expectation-maximisation
over the counted vote patterns estimates how reliable each labeler is; the posteriors train a classifier over what a
span looks like, which decides on the candidates.
"""

from __future__ import annotations

from dataclasses import dataclass
from math import exp, log

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chemlake.llm.arrays import bound, prefix_fold, unused_name
from chemlake.llm.workspace import Workspace

#: Kinds in the order in which spans are listed; the first four have base patterns.
KINDS = ("email", "ip", "card", "phone", "ssn", "secret")
BASE_KINDS = KINDS[:4]

# The base patterns. Each starts where a run of its first class starts, or where the match
# before it ended, and takes groups possessively: the same matches, in time linear in the text.
BASE = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
# Further candidates, which the labelers vote on. No match of one is a match of its base pattern.
LOOSE = {
    "email": r"(?i)(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}+(?:\x20?(?:\[at\]|\(at\)|\x20at\x20)\x20?[A-Za-z0-9-]{1,63}\x20?(?:\[dot\]|\(dot\)|\x20dot\x20)\x20?[A-Za-z]{2,24}|@[A-Za-z0-9-]++(?!\.[A-Za-z0-9-]))",
    "ip": r"(?<![0-9.])[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}(?!\.?[0-9])",
    "phone": r"(?<![0-9A-Za-z+.-])\(?[0-9]{2,4}\)?[\x20.-][0-9]{3,4}[\x20.-][0-9]{3,4}(?![0-9A-Za-z]|[.-][0-9])",
    "ssn": r"(?<![0-9A-Za-z-])[0-9]{3}[\x20-][0-9]{2}[\x20-][0-9]{4}(?![0-9A-Za-z-])",
    "secret": r"(?i)(?:token|secret|passw(?:or)?d|pwd|api[_-]?key)[\"']?\s{0,3}[:=]\s{0,3}[\"']?[A-Za-z0-9+/_=.-]{12,}+|(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{32,}+",
}
# What a text must hold for a pattern to be tried.
NEEDS = {"email": "@", "ip": r"[0-9]\.[0-9]", "card": r"[0-9][\x20-]?[0-9]", "phone": r"\+[0-9]"}
LOOSE_NEEDS = {"email": r"@|(?i)[\[(\x20]dot[\])\x20]", "ip": r"[0-9]\.[0-9]", "phone": r"[0-9][\x20.-][0-9]", "ssn": r"[0-9][\x20-][0-9]", "secret": r"[:=]\s{0,3}[\"']?[A-Za-z0-9+/_=.-]{12}|[A-Za-z0-9+/_-]{32}"}
#: Kinds whose spans all hold a digit.
DIGITS = ("ip", "card", "phone", "ssn")
# The shape of each kind as it is mostly written.
SHAPES = {
    "email": r"^[A-Za-z0-9][A-Za-z0-9._%+-]*+@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++(?<=\.[A-Za-z]{2,24})$",
    "ip": r"^(?:0|[1-9][0-9]{0,2})(?:\.(?:0|[1-9][0-9]{0,2})){3}$",
    "card": r"^(?:[0-9]{4}([\x20-]?)[0-9]{4}\1[0-9]{4}\1[0-9]{4}|3[0-9]{3}([\x20-]?)[0-9]{6}\2[0-9]{4,5})$",
    "phone": r"^(?:\+[1-9][0-9]{0,2}[\x20.-]?)?(?:\([0-9]{1,4}\)|[0-9]{1,4})(?:[\x20.-]?[0-9]{2,4}){2,4}$",
    "ssn": r"^[0-9]{3}-[0-9]{2}-[0-9]{4}$",
    "secret": r"(?i)^[a-z_-]+[\"']?\s*[:=]",
}
# Names and number ranges that belong to a kind: top-level domains, networks of hosts, card issuers, country
# codes, issued areas, and forms of keys.
GAZETTEER = {
    "email": r"(?i)(?:\.|dot[\])\x20]\x20?)(?:com|net|org|edu|gov|info|io|de|fr|es|uk|it|nl|eu)$",
    "ip": r"^(?:[1-9][0-9]?|1(?:[013-9][0-9]|2[0-689])|2(?:[01][0-9]|2[0-3]))\.",
    "card": r"^(?:4|5[\x20-]?[1-5]|3[\x20-]?[47]|6[\x20-]?(?:011|5)|2[\x20-]?(?:22[1-9]|2[3-9]|[3-6]|7[01]|720))",
    "phone": r"^\+(?:1|7|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58])",
    "ssn": r"^(?:00[1-9]|0[1-9][0-9]|[1-6][0-9]{2}|7[0-6][0-9]|77[0-2])",
    "secret": r"(?i)(?:sk-|ghp_|AKIA|eyJ|xox[bp]-)|(?<![0-9a-f])(?:[0-9a-f]{32}|[0-9a-f]{40}|[0-9a-f]{64})$",
}
# Words that announce a kind, looked for in the CONTEXT characters before a span, or in a secret.
CUES = {
    "email": "mail|contact|write|courriel|correo",
    "ip": "ip|host|server|address|adresse",
    "card": "card|visa|master|credit|karte|carte|tarjeta|pay",
    "phone": "phone|tel|call|mobile|fax|anruf|ruf|llam|appel",
    "ssn": "ssn|social|security|tax|id",
    "secret": "token|secret|passw|pwd|key",
}
CONTEXT = 24
#: Labelers, in the order of their votes. Each votes 1 or 0.
LABELERS = ("shape", "checksum", "gazetteer", "cue", "neighbours")
ROUNDS = 50


_EMPTY = "array<struct<begin:int,end:int,text:string,before:string,after:string>>"


def matches(text: Column, pattern: str, needs: str) -> Column:
    """Leftmost non-overlapping matches: begin, end (code points, end exclusive) and text of each, and CONTEXT characters before and after it.

    All of it comes from the matches and the gaps between them, by folds over these, so the work is linear in the text.
    """
    last = lambda a, b: F.right(F.concat(a, b), F.lit(CONTEXT))
    first = lambda a, b: F.left(F.concat(b, a), F.lit(CONTEXT))  # noqa: E731  the array is turned round
    all_but = lambda x, start: F.slice(x, start, F.greatest(F.size(x) - 1, F.lit(0)))

    def folded(b: Column) -> Column:
        """Matches with the gap before and after each, and the folds over both."""
        found, firsts, lasts = b["found"], F.slice(b["gaps"], 1, F.size(b["found"])), F.slice(b["gaps"], 2, F.size(b["found"]))
        ends = prefix_fold(F.zip_with(found, firsts, lambda m, g: F.length(m) + F.length(g)), lambda a, b: a + b)
        upto = prefix_fold(F.zip_with(firsts, found, last), last)
        onward = F.reverse(prefix_fold(F.reverse(F.zip_with(found, lasts, lambda m, g: F.left(F.concat(m, g), F.lit(CONTEXT)))), first))
        return bound(F.struct(found.alias("found"), firsts.alias("firsts"), lasts.alias("lasts"), ends.alias("ends"), upto.alias("upto"), onward.alias("onward")), placed)

    def placed(b: Column) -> Column:
        before = F.zip_with(F.concat(F.array(F.lit("")), all_but(b["upto"], 1)), b["firsts"], last)
        after = F.zip_with(b["lasts"], F.concat(all_but(b["onward"], 2), F.array(F.lit(""))), lambda g, more: F.left(F.concat(g, more), F.lit(CONTEXT)))
        zipped = F.arrays_zip(b["found"].alias("text"), b["ends"].alias("end"), before.alias("before"), after.alias("after"))
        return F.transform(zipped, lambda z: F.struct((z["end"] - F.length(z["text"])).alias("begin"), z["end"].alias("end"), z["text"].alias("text"), z["before"].alias("before"), z["after"].alias("after")))

    none = F.array().cast(_EMPTY)
    held = F.contains(text, F.lit(needs)) if needs == "@" else F.rlike(text, F.lit(needs))
    # what is used several times is bound, so that it is worked out once
    spans = bound(F.struct(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("found"), F.split(text, pattern, -1).alias("gaps")), folded)
    return F.when(held & (F.regexp_count(text, F.lit(pattern)) > 0), spans).otherwise(none)


def _digits(x: Column) -> Column:
    return F.regexp_replace(x, "[^0-9]", "")


def strict(kind: str, x: Column) -> Column:
    """What a base match must hold beside its pattern."""
    if kind == "ip":
        part = r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[0-9]{1,2})"
        return F.rlike(x, F.lit(rf"^{part}(?:\.{part}){{3}}$"))
    if kind == "card":
        digits = _digits(x)
        return F.when(F.length(digits).between(16, 19), F.call_function("luhn_check", digits)).otherwise(F.lit(False))
    if kind == "phone":
        return F.length(_digits(x)).between(8, 15)
    return F.lit(True)


def _passing(kind: str):
    return lambda span: strict(kind, span["text"])


def _checked(kind: str, x: Column) -> Column:
    """Whether the parts of a span are possible: a checksum, ranges of numbers, or, of a secret, letters and digits mixed."""
    if kind == "email":
        return ~F.rlike(x, F.lit(r"\.\.|^[.-]|[.-]@|@[.-]|-\."))
    if kind == "ip":
        return strict("ip", x)
    if kind == "card":
        return F.call_function("luhn_check", _digits(x))
    if kind == "phone":
        return F.length(_digits(x)).between(8, 15)
    if kind == "ssn":
        return ~F.rlike(x, F.lit(r"^(?:000|666|9)|[\x20-]00[\x20-]|[\x20-]0000$"))
    value = F.regexp_extract(x, r"[A-Za-z0-9+/_.-]*=*$", 0)
    return F.rlike(value, F.lit("[0-9].*[0-9].*[0-9]")) & F.rlike(value, F.lit("[A-Za-z].*[A-Za-z].*[A-Za-z]"))


def _described(kind: str, spans: Column, base: Column | bool) -> Column:
    """Candidates with their votes and looks. A look is 'feature=value', a vote pattern a string of 0 and 1."""
    cue = rf"(?i)(?:{CUES[kind]})[^0-9A-Za-z]*\S{{0,12}}\s*$"

    def one(s: Column) -> Column:
        x, before, after = s["text"], s["before"], s["after"]
        glued = F.rlike(before, F.lit("[0-9A-Za-z_]$")) | F.rlike(after, F.lit("^[0-9A-Za-z_]"))
        digits = F.length(_digits(x))
        valid = F.coalesce(base(x), F.lit(False)) if callable(base) else F.lit(base)
        cued = F.rlike(x, F.lit(f"(?i)^(?:{CUES[kind]})")) if kind == "secret" else F.rlike(before, F.lit(cue))
        alone = ~F.rlike(before, F.lit(r"[0-9]\S*\s*$")) & ~F.rlike(after, F.lit(r"^\S*\s*\S*[0-9]"))
        ballot = (F.rlike(x, F.lit(SHAPES[kind])) & ~glued, _checked(kind, x), F.rlike(x, F.lit(GAZETTEER[kind])), cued, alone)
        votes = F.concat(*[F.when(F.coalesce(v, F.lit(False)), "1").otherwise("0") for v in ballot])
        looks = F.array(
            F.concat(F.lit("length="), F.least(F.floor(F.log2(F.length(x).cast("double") + 1)), F.lit(8)).cast("string")),
            F.concat(F.lit("digits="), F.floor(digits * 4 / F.length(x)).cast("string")),
            F.concat(F.lit("marks="), F.least(F.length(F.regexp_replace(x, "[0-9A-Za-z]", "")), F.lit(6)).cast("string")),
            F.concat(F.lit("glued="), F.when(glued, "1").otherwise("0")),
            *[F.concat(F.lit(f"{name}="), F.substring(votes, i + 1, 1)) for i, name in enumerate(LABELERS) if i],
        )
        return F.struct(F.lit(kind).alias("kind"), s["begin"].alias("begin"), s["end"].alias("end"), valid.alias("base"), votes.alias("votes"), looks.alias("looks"))

    return F.transform(spans, one)


_CANDIDATES = "array<struct<kind:string,begin:int,end:int,base:boolean,votes:string,looks:array<string>>>"


def candidates(text: Column) -> Column:
    """All candidates of a text: matches of the base patterns, also those that fail (cards: of 13 digits or more), and loose matches."""
    digits, others = [], []
    for kind, patterns, needs in [*((k, BASE, NEEDS) for k in BASE_KINDS), *((k, LOOSE, LOOSE_NEEDS) for k in LOOSE)]:
        spans = matches(text, patterns[kind], needs[kind])
        if patterns is BASE and kind == "card":
            spans = F.filter(spans, lambda s: F.length(_digits(s["text"])).between(13, 19))
        base = (lambda x, k=kind: strict(k, x)) if patterns is BASE else False
        (digits if kind in DIGITS else others).append(_described(kind, spans, base))
    with_digits = F.when(F.rlike(text, F.lit("[0-9]")), F.concat(*digits)).otherwise(F.array().cast(_CANDIDATES))
    return F.concat(with_digits, *others)


@dataclass
class Model:
    """Of each kind: reliability of the labelers, and the classifier's weights by look."""

    reliability: dict[str, tuple[float, list[tuple[float, float]]]]
    weights: dict[str, float]


def train(found: DataFrame, column: str) -> Model:
    """Expectation-maximisation, then the classifier, over counts of the candidates in an array column.

    Counting is Spark's; what comes to the driver is one row per kind, vote pattern and look (a few thousand at most,
    whatever the corpus).
    """
    rows = found.select(F.explode(column).alias("c"))
    counted = rows.groupBy("c.kind", "c.votes", "c.looks").count().collect()
    reliability, weights = {}, {}
    for kind in KINDS:
        own = [(tuple(map(int, r.votes)), tuple(r.looks), r["count"]) for r in counted if r.kind == kind]
        if not own:
            continue
        prior, rates = expectation_maximisation([(v, n) for v, _, n in own])
        reliability[kind] = prior, rates
        weights |= _look_weights(kind, [(posterior(v, prior, rates), looks, n) for v, looks, n in own])
    return Model(reliability, weights)


def posterior(votes, prior: float, rates) -> float:
    odds = log(prior / (1 - prior))
    for vote, (hit, false) in zip(votes, rates, strict=True):
        odds += log(hit / false) if vote else log((1 - hit) / (1 - false))
    return 1 / (1 + exp(-max(-30.0, min(30.0, odds))))


def expectation_maximisation(counts: list[tuple[tuple[int, ...], int]]) -> tuple[float, list[tuple[float, float]]]:
    """(share of true spans, rate of votes on true and on false spans of each labeler), from vote patterns.

    Pseudo-counts hold labelers to be better than chance, which also names the two classes.
    """
    n = sum(c for _, c in counts)
    prior, rates = 0.5, [(0.8, 0.2)] * len(LABELERS)
    for _ in range(ROUNDS):
        weighted = [(v, c * posterior(v, prior, rates), c) for v, c in counts]
        true = sum(p for _, p, _ in weighted)
        prior = (true + 2) / (n + 4)
        rates = [((sum(p for v, p, _ in weighted if v[i]) + 8) / (true + 10), (sum(c - p for v, p, c in weighted if v[i]) + 2) / (n - true + 10)) for i in range(len(LABELERS))]
    return prior, rates


def _look_weights(kind: str, rows: list[tuple[float, tuple[str, ...], int]]) -> dict[str, float]:
    true, false = sum(p * n for p, _, n in rows), sum((1 - p) * n for p, _, n in rows)
    found = {f"{kind}": log((true + 1) / (false + 1))}
    seen: dict[str, list[float]] = {}
    for p, looks, n in rows:
        for look in looks:
            at = seen.setdefault(look, [0.0, 0.0])
            at[0] += p * n
            at[1] += (1 - p) * n
    for look, (t, f) in seen.items():
        found[f"{kind}|{look}"] = log((t + 0.5) / (true + 4)) - log((f + 0.5) / (false + 4))
    return found


_FOUND = "array<struct<kind:string,begin:int,end:int,base:boolean>>"


def find_personal_data(docs: DataFrame, model: Model | None = None, *, text: str = "text", out: str = "personal", carry: list[str] | None = None) -> DataFrame:
    """docs (or its columns `carry`) with the array `out` of spans: kind, begin, end (code points, end exclusive), base.

    Spans are listed by kind, then begin; spans of different kinds may overlap.  Further spans are those whose looks the
    classifier holds to be likelier true than not (ties are not) and that touch no base span; numbers must pass their
    checksum or range, too.  A null or empty text has none.  Texts are read whole, in time linear in their length.  Rows are looked at one by one, so repeated rows have equal spans, and an empty table stays
    empty.  Where no model is given, candidates are written once, and the model is trained on all of them.  A column
    called `out` is replaced, others are kept.
    """
    whole = F.coalesce(F.col(text), F.lit(""))
    columns = [c for c in (docs.columns if carry is None else carry) if c != out]
    every = docs.select(*columns, candidates(whole).alias(out))
    if model is None:
        every = Workspace(docs.sparkSession).save(every, "candidates")
        model = train(every, out)
    weights = F.create_map(*[F.lit(x) for k, w in sorted(model.weights.items()) for x in (k, float(w))]) if model.weights else F.create_map().cast("map<string,double>")
    score = lambda c: F.aggregate(c["looks"], F.coalesce(F.try_element_at(weights, c["kind"]), F.lit(-1.0)), lambda s, look: s + F.coalesce(F.try_element_at(weights, F.concat_ws("|", c["kind"], look)), F.lit(0.0)))
    order = F.create_map(*[F.lit(x) for i, k in enumerate(KINDS) for x in (k, i)])
    sound = lambda c: ~c["kind"].isin(*DIGITS) | (F.substring(c["votes"], 2, 1) == "1")
    likely = F.filter(F.col(out), lambda c: c["base"] | (sound(c) & (score(c) > 0)))
    plain = lambda c: F.struct(c["begin"].alias("begin"), c["end"].alias("end"), order[c["kind"]].alias("place"), c["kind"].alias("kind"), c["base"].alias("base"))
    listed = F.array_sort(F.transform(bound(F.array_sort(F.transform(likely, plain)), _apart), lambda c: F.struct(c["place"].alias("place"), c["begin"].alias("begin"), c["end"].alias("end"), c["kind"].alias("kind"), c["base"].alias("base"))))
    named = F.transform(listed, lambda c: F.struct(c["kind"].alias("kind"), c["begin"].alias("begin"), c["end"].alias("end"), c["base"].alias("base")))
    return every.withColumn(out, F.when(F.size(out) > 0, named).otherwise(F.array().cast(_FOUND)))


def _apart(spans: Column) -> Column:
    """Of spans in order of begin and end, the base ones and those that touch none of these.

    A span touches a base one that begins before it if the farthest end of those is beyond its begin, and one that
    begins after it if the nearest begin of those is before its end: two folds, and no span is held against all others.
    """
    reach = prefix_fold(F.transform(spans, lambda s: F.when(s["base"], s["end"]).otherwise(-1)), F.greatest)
    following = F.reverse(prefix_fold(F.reverse(F.transform(spans, lambda s: F.when(s["base"], s["begin"]).otherwise(2**31 - 1))), F.least))
    zipped = F.arrays_zip(spans.alias("span"), reach.alias("reach"), following.alias("following"))
    return F.transform(F.filter(zipped, lambda z: z["span"]["base"] | ((z["reach"] <= z["span"]["begin"]) & (z["following"] >= z["span"]["end"]))), lambda z: z["span"])


#: The mark of byte order that a decoder of UTF-32 drops, whatever follows it.
_MARK = "X'0000FEFF'"


def masked(text: Column, spans: Column) -> Column:
    """text with each span, or run of overlapping ones, replaced by [KIND] of its first.

    The places are found by one sort and one fold; the pieces between are cut from the text with four bytes to a
    character, where a place is found without counting.  What all pieces need is bound once.
    """
    by_place = F.array_sort(F.transform(spans, lambda s: F.struct(s["begin"].alias("begin"), (-s["end"]).alias("last"), s["kind"].alias("kind"))))

    def cut(b: Column) -> Column:
        reach = prefix_fold(F.transform(b["spans"], lambda s: -s["last"]), F.greatest)
        # what stands after the last span is one more piece, without a mark
        zipped = F.arrays_zip(b["spans"].alias("span"), F.concat(F.array(F.lit(0)), reach).alias("before"))
        heads = F.filter(zipped, lambda z, i: z["span"].isNull() | (i == 0) | (z["span"]["begin"] >= z["before"]))
        size = lambda h: F.coalesce((h["span"]["begin"] - h["before"]) * 4, F.lit(2**31 - 1))
        piece = lambda h: F.decode(F.concat(F.expr(_MARK), F.substring(b["wide"], h["before"] * 4 + 1, size(h))), "UTF-32")
        mark = lambda h: F.when(h["span"].isNotNull(), F.concat(F.lit("["), F.upper(h["span"]["kind"]), F.lit("]"))).otherwise("")
        return F.array_join(F.transform(heads, lambda h: F.concat(piece(h), mark(h))), "")

    return F.when(F.size(spans) > 0, bound(F.struct(by_place.alias("spans"), F.encode(text, "UTF-32").alias("wide")), cut)).otherwise(text)


def mask_personal_data(docs: DataFrame, model: Model | None = None, *, text: str = "text") -> DataFrame:
    """docs with personal data in text replaced by [EMAIL], [IP] and so on; null texts stay null."""
    name = unused_name(docs, "personal")
    found = find_personal_data(docs, model, text=text, out=name)
    return found.withColumn(text, masked(F.col(text), F.col(name))).select(*docs.columns)

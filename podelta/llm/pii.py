"""Personal data by candidate boosting (operator 10), in DataFrame functions and Spark ML only.

Fixed expressions with their checks give the base spans, which always stay.  High-recall generators propose further,
overlapping candidates; gradient-boosted trees score them by format and context, and per kind a threshold calibrated on
held-out candidates selects redactions.  The trees are trained here and compiled into column expressions, so that scoring is
part of the scan and moves no rows.  Their labels do not depend on the base match: checked spans are rewritten in other
formats (positives) and into look-alikes that fail a check or are ids, prices and dates (negatives), and candidates that
no base span touches count where format, checks and context tell.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from podelta.llm.common import bind, free_name, stage
from podelta.llm.trees import predict, read_tree

#: Kinds in the order in which they are listed.
KINDS = ("email", "ip", "card", "phone")
MAX_PART, CARD_DIGITS, PHONE_DIGITS = 255, (16, 19), (8, 15)

# The same matches as the plain expressions [A-Za-z0-9._%+-]+@..., [0-9]+(\.[0-9]+)..., [0-9]([\x20-]?[0-9])+ and
# \+[0-9][\x20().0-9-]+[0-9] with their digit counts, written so that no position is tried twice.
_LOCAL, _DOMAIN = "[A-Za-z0-9._%+-]", "[A-Za-z0-9-]"
BASE = {
    "email": rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@{_DOMAIN}++(?:\.{_DOMAIN}++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){%d,%d}(?![\x20-]?[0-9])" % (CARD_DIGITS[0] - 1, CARD_DIGITS[1] - 1),
    "phone": r"\+[0-9](?:[\x20().-]*+[0-9]){%d,%d}(?![\x20().-]*+[0-9])" % (PHONE_DIGITS[0] - 1, PHONE_DIGITS[1] - 1),
}
#: High-recall generators: spelled-out or odd addresses, dotted or dashed quads, long digit groups, numbers without plus.
CANDIDATES = {
    "email": r"(?<![^\s@,;:<>()\[\]\"])[^\s@,;:<>()\[\]\"]{1,64}(?:@|[\x20]?[(\[]at[)\]][\x20]?)[^\s@,;:<>()\[\]\"]{0,254}[\p{L}\p{N}]",
    "ip": r"(?<![0-9])[0-9]{1,4}(?:[.-][0-9]{1,4}){3}(?![0-9])",
    "card": r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){11,21}(?![\x20-]?[0-9])",
    "phone": r"(?<![0-9])(?:\+|\(|00)?[0-9](?:[\x20().-]{0,3}[0-9]){6,17}(?![0-9])",
}
CONTEXT = {
    "email": ("mail", "contact", "write"), "ip": ("ip", "host", "server", "addr"),
    "card": ("card", "visa", "credit", "iban", "account"), "phone": ("phone", "tel", "call", "mobile", "fax"),
}
#: What a text holds if an expression matches in it at all; texts without it are spared the expressions.
NEEDS = {"email": ("@",), "phone": ("+",)}
CANDIDATE_NEEDS = {"email": ("@", "(at", "[at")}
FEATURES = ("email", "ip", "card", "phone", "length", "digits", "separators", "dots", "plus", "brackets", "at", "luhn",
            "parts_fit", "distinct", "digit_before", "letter_before", "letter_after", "digit_after", "context", "all_digits",
            "domain", "issuer", "area", "trunk", "price", "date", "decimal", "padded", "joined")
#: Features that tell of one kind only; they are 0 for the others.
ONLY = {"domain": "email", "parts_fit": "ip", "padded": "ip", "joined": "ip", "luhn": "card", "issuer": "card", "area": "phone",
        "trunk": "phone", "price": "phone", "date": "phone", "decimal": "phone"}
BEFORE, AFTER = 24, 4  # characters of context
#: What the further features look for; the issuer's digits and length are those of payment cards.
_DOMAIN_END = r"(?:@|[)\]]\x20?)[\p{L}\p{N}-]+(?:\.[\p{L}\p{N}-]+)*\.\p{L}{2,}$"
_ISSUER = (r"^(?:3[47][0-9]{13}|3(?:0[0-5]|[68][0-9])[0-9]{11}|4[0-9]{12}(?:[0-9]{3}){0,2}|(?:5[1-5]|2[2-7])[0-9]{14}|6[0-9]{15,18})$")
_MONEY = "[$€£¥]|eur|usd|gbp|chf"
_DATE = (r"^(?:(?:19|20)[0-9]{2}[.-](?:0[1-9]|1[0-2])[.-](?:0[1-9]|[12][0-9]|3[01])|"
         r"(?:0[1-9]|[12][0-9]|3[01])[.-](?:0[1-9]|1[0-2])[.-](?:19|20)[0-9]{2})(?![0-9])")

#: Weight that all candidates carry together at most, and all rewritten spans; the precision that calibration asks of held-out ones.
TRAIN_ROWS, PRECISION, TREES, DEPTH, SEED = 20_000, 0.95, 10, 4, 5
_BLOCK = 512
SPANS = "array<struct<kind:string,start:int,end:int>>"


def _prefix(values: Column) -> Column:
    """Sums of all entries before each entry, and of all."""
    return F.aggregate(values, F.array(F.lit(0)), lambda a, x: F.concat(a, F.array(F.element_at(a, -1) + x)))


def starts_of(lengths: Column) -> Column:
    """Running sums in blocks, so that very many matches cost no square."""
    def blocked(v: Column) -> Column:
        cut = F.transform(F.sequence(F.lit(0), F.floor((F.size(v) - 1) / _BLOCK).cast("int")), lambda b: F.slice(v, b * _BLOCK + 1, F.lit(_BLOCK)))
        return bind(cut, lambda bs: bind(_prefix(F.transform(bs, lambda b: F.aggregate(b, F.lit(0), lambda s, x: s + x))), lambda offs: F.flatten(
            F.transform(bs, lambda b, i: F.transform(F.slice(_prefix(b), F.lit(1), F.size(b)), lambda s: s + F.get(offs, i))))))

    return F.when(F.size(lengths) > 0, bind(lengths, blocked)).otherwise(F.array().cast("array<int>"))


def may_hold(text: Column, signs: tuple | None) -> Column:
    """Whether the text holds one of ``signs``, or a digit if there are none."""
    if not signs:
        return F.regexp_like(text, F.lit("[0-9]"))
    out = F.contains(text, F.lit(signs[0]))
    for sign in signs[1:]:
        out = out | F.contains(text, F.lit(sign))
    return out


def matches(text: Column, pattern: str, signs: tuple | None = None) -> Column:
    """Leftmost non-overlapping matches: array of (start, end, value), code points, end exclusive.

    A match must hold one of ``signs``, or a digit if there are none.
    """
    # What lies between matches gives their places.
    both = F.struct(F.split(text, pattern, -1).alias("gaps"), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("found"))

    def place(b: Column) -> Column:
        gap = lambda i: F.length(F.get(b["gaps"], i))
        steps = F.transform(b["found"], lambda v, i: F.length(v) + gap(i))
        return bind(starts_of(steps), lambda s: F.transform(b["found"], lambda v, i: F.struct(
            (F.get(s, i) + gap(i)).alias("start"), (F.get(s, i) + gap(i) + F.length(v)).alias("end"), v.alias("value"))))

    empty = F.array().cast("array<struct<start:int,end:int,value:string>>")
    return F.when(may_hold(text, signs) & F.regexp_like(text, F.lit(pattern)), bind(both, place)).otherwise(empty)


def digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(number: Column) -> Column:
    """Luhn check of a string of digits."""
    ds = F.transform(F.filter(F.split(F.reverse(number), ""), lambda c: c != ""), lambda c, i: bind(
        c.cast("int") * F.when(i % 2 == 1, 2).otherwise(1), lambda d: F.when(d > 9, d - 9).otherwise(d)))
    return F.aggregate(ds, F.lit(0), lambda s, d: s + d) % 10 == 0


def parts_fit(value: Column) -> Column:
    """Every part of a dotted or dashed number is at most 255."""
    return F.forall(F.split(value, "[.-]"), lambda p: F.regexp_like(p, F.lit(r"^0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])$")))


def base_spans(text: Column) -> Column:
    """Base spans by kind as listed, then start: array of (kind, start, end).  Null text has none."""
    text = F.coalesce(text, F.lit(""))
    checks = {"ip": parts_fit, "card": lambda v: luhn(digits(v))}

    def of(kind: str) -> Column:
        found = matches(text, BASE[kind], NEEDS.get(kind))
        if kind in checks:
            found = F.filter(found, lambda m: checks[kind](m["value"]))
        return F.transform(found, lambda m: F.struct(F.lit(kind).alias("kind"), m["start"].alias("start"), m["end"].alias("end"))).cast(SPANS)

    return F.concat(*map(of, KINDS))


def candidates(text: Column) -> Column:
    """Proposed spans of all generators: array of (kind, start, end, f), f the features in the order of FEATURES."""
    text = F.coalesce(text, F.lit(""))
    number = lambda test: F.when(F.coalesce(test, F.lit(False)), 1.0).otherwise(0.0)

    def features(kind: str, m: Column) -> Column:
        v = m["value"]
        first = F.greatest(m["start"] - BEFORE, F.lit(0))
        before = F.lower(F.substring(text, first + 1, m["start"] - first))
        after = F.substring(text, m["end"] + 1, F.lit(AFTER))
        count = lambda chars: (F.length(v) - F.length(F.translate(v, chars, ""))).cast("double")
        f = {k: F.lit(float(k == kind)) for k in KINDS} | {
            "length": F.length(v).cast("double"), "digits": count("0123456789"), "separators": count(" -()."), "dots": count("."),
            "plus": number(v.startswith("+")), "brackets": count("()"), "at": count("@"), "luhn": number(luhn(digits(v))),
            "parts_fit": number(parts_fit(v)), "distinct": F.size(F.array_distinct(F.split(digits(v), ""))).cast("double"),
            "digit_before": number(F.regexp_like(before, F.lit("[0-9]$"))), "letter_before": number(F.regexp_like(before, F.lit(r"\p{L}$"))),
            "letter_after": number(F.regexp_like(after, F.lit(r"^\p{L}"))), "digit_after": number(F.regexp_like(after, F.lit("^[0-9]"))),
            "context": number(F.regexp_like(before, F.lit("|".join(CONTEXT[kind])))), "all_digits": number(F.regexp_like(v, F.lit("^[0-9]+$"))),
            "domain": number(F.regexp_like(v, F.lit(_DOMAIN_END))), "issuer": number(F.regexp_like(digits(v), F.lit(_ISSUER))),
            "area": number(F.regexp_like(v, F.lit(r"^\([0-9]{2,5}\)"))), "trunk": number(F.regexp_like(v, F.lit("^00[1-9]"))),
            "price": number(F.regexp_like(before, F.lit(rf"(?:{_MONEY})\s?$")) | F.regexp_like(F.lower(after), F.lit(rf"^\s?(?:{_MONEY}|%)"))),
            "date": number(F.regexp_like(v, F.lit(_DATE))), "decimal": number(F.regexp_like(v, F.lit(r"^[0-9]+\.[0-9]+$"))),
            "padded": number(F.regexp_like(v, F.lit("(?:^|[.-])0[0-9]"))),
            "joined": number(F.regexp_like(before, F.lit("[0-9][.-]$")) | F.regexp_like(after, F.lit("^[.-][0-9]")))}
        return F.array(*(F.lit(0.0) if ONLY.get(name, kind) != kind else f[name] for name in FEATURES))

    def of(kind: str) -> Column:
        return F.transform(matches(text, CANDIDATES[kind], CANDIDATE_NEEDS.get(kind)), lambda m: F.struct(
            F.lit(kind).alias("kind"), m["start"].alias("start"), m["end"].alias("end"), features(kind, m).alias("f"))).cast(
                "array<struct<kind:string,start:int,end:int,f:array<double>>>")

    return F.concat(*map(of, KINDS))


@dataclass(frozen=True)
class Booster:
    """Trees, their weights, and per kind the least score that selects (absent: the kind adds nothing)."""

    trees: tuple
    weights: tuple
    thresholds: dict

    def score(self, f: Column) -> Column:
        margin = None
        for tree, weight in zip(self.trees, self.weights):
            value = predict(tree, lambda i: F.get(f, F.lit(i))) * F.lit(float(weight))
            margin = value if margin is None else margin + value
        return F.lit(1.0) / (F.lit(1.0) + F.exp(F.lit(-2.0) * margin))

    def selects(self, c: Column) -> Column:
        if not self.trees or not self.thresholds:
            return F.lit(False)
        limit = F.lit(2.0)
        for kind, least in self.thresholds.items():
            limit = F.when(c["kind"] == kind, F.lit(float(least))).otherwise(limit)
        return self.score(c["f"]) >= limit


def evidence(kind: Column, value: Column, f: Column) -> Column:
    """1 or 0 for a candidate that no base span touches, by its format, checks and context; null if they do not tell."""
    has = lambda name: F.get(f, F.lit(FEATURES.index(name))) > 0
    n = F.get(f, F.lit(FEATURES.index("digits")))
    spaced = has("separators") & ~has("all_digits")
    email = F.when(has("domain"), 1.0).when(F.regexp_like(value, F.lit(r"(?:@|[)\]]\x20?)[^.]*$")), 0.0)
    ip = F.when(~has("parts_fit") | has("joined"), 0.0).when(has("context") & ~has("padded"), 1.0)
    card = (F.when(~has("luhn"), 0.0).when(has("issuer") & (has("context") | (n >= 15)), 1.0)
            .when(~has("issuer") & ~has("context"), 0.0))
    phone = (F.when(has("price") | has("date") | has("decimal") | (n > PHONE_DIGITS[1]), 0.0)
             .when(has("all_digits") & ~has("trunk") & ~has("context"), 0.0)
             .when(spaced & (has("context") | has("area") | has("trunk")), 1.0))
    return F.when(kind == "email", email).when(kind == "ip", ip).when(kind == "card", card).otherwise(phone)


def rewritten(kind: Column, before: Column, value: Column, after: Column) -> Column:
    """Other formats (label 1) and look-alikes (label 0) of a checked span: array of (before, value, after, label)."""
    d = digits(value)
    part = lambda x, start, n: F.substring(x, start, n)
    form = lambda x, label, lead=before, tail=after: F.struct(
        lead.alias("before"), x.alias("value"), tail.alias("after"), F.lit(label).alias("label"))
    text = F.lit

    # Addresses, as they are and without digits: the @ spelled out; a word before and after it without a domain.
    local, domain = F.substring_index(value, "@", 1), F.substring_index(value, "@", -1)
    label = F.substring_index(domain, ".", 1)
    spelled = lambda at, end: [x for x in [F.concat(local, text(at), end)] for x in (x, F.translate(x, "0123456789", "abcdefghij"))]
    email = F.when(F.regexp_like(domain, F.lit(r"\.[A-Za-z]{2,}$")), F.array(
        *(form(x, 1.0) for at in (" (at) ", "(at)", " [at] ", "[at]") for x in spelled(at, domain)),
        *(form(x, 0.0, tail=text(" ")) for at in ("@", " (at) ", "(at)", " [at] ", "[at]") for end in (label, F.translate(domain, ".", "-"))
          for x in spelled(at, end))))

    # Quads, as they are and shorter: dashes; parts over 255, leading zeros, and quads within longer numbers.
    dashed, rest = F.translate(value, ".", "-"), F.substring_index(value, ".", -3)
    ip = F.array(
        form(dashed, 1.0), form(F.concat(text("999."), rest), 0.0), form(F.concat(text("1998-"), F.translate(rest, ".", "-")), 0.0),
        form(F.concat(F.translate(F.substring_index(value, ".", 3), ".", "-"), text("-300")), 0.0), form(dashed, 0.0, tail=text("-12 ")),
        form(F.regexp_replace(dashed, "([0-9]{2})[0-9]", "$1"), 1.0), form(F.concat(text("0"), dashed), 0.0),
        form(F.concat(text("0"), F.regexp_replace(dashed, "([0-9]{2})[0-9]", "$1")), 0.0))

    # Cards: other lengths and groups with a right check digit; a wrong one, and checked numbers of no issuer.
    def checked(x: Column) -> Column:
        return F.element_at(F.filter(F.array(*(F.concat(x, text(str(i))) for i in range(10))), luhn), 1)

    def failed(x: Column) -> Column:
        return F.concat(F.substring(x, F.lit(1), F.length(x) - 1), F.translate(F.substring(x, -1, 1), "0123456789", "1234567890"))

    cut = lambda x, sign, last: F.concat_ws(sign, part(x, 1, 4), part(x, 5, 6), part(x, 11, last))
    fours = lambda x, sign: F.concat_ws(sign, part(x, 1, 4), part(x, 5, 4), part(x, 9, 4), part(x, 13, 7))
    long, short = checked(F.concat(text("37"), part(d, 3, 12))), checked(F.concat(text("36"), part(d, 3, 11)))
    other = checked(F.concat(text("98"), part(d, 3, 12)))
    forms = [(x, y) for x in (long,) for y in (x, cut(x, " ", 5), cut(x, "-", 5))] + [(short, y) for y in (short, cut(short, " ", 4), cut(short, "-", 4))]
    wrong = [failed(long), cut(failed(long), " ", 5), cut(failed(long), "-", 5), failed(short), failed(d), fours(failed(d), " ")]
    card = F.array(*(form(y, 1.0) for _, y in forms), *(form(y, 0.0) for y in wrong),
                   *(form(y, 0.0, lead=text("order ")) for y in (other, cut(other, "-", 5))))

    # Phone numbers: no plus, two zeros, no country; ids, prices, days and times of the same digits.
    plain = F.substring(value, F.lit(2), F.length(value))
    home = F.regexp_replace(value, r"^\+[0-9]{1,3}[\x20.-]*(?=\()|^\+[0-9]{1,3}[\x20.-]+(?=[0-9])", "")
    home = F.when(home.startswith("("), home).when(~home.startswith("+"), F.concat(text("0"), home))
    spaced = lambda x: F.when(F.regexp_like(x, F.lit("[^0-9]")), x)
    day = F.concat(text("20"), part(d, 1, 2), text("-0"), F.greatest(text("1"), part(d, 3, 1)), text("-1"), part(d, 4, 1))
    money = F.concat(part(d, 1, 6), text("."), part(d, 7, 2))
    phone = F.array(
        form(spaced(plain), 1.0), form(F.concat(text("00"), F.regexp_replace(plain, "^0+", "")), 1.0), form(spaced(home), 1.0),
        form(d, 0.0, lead=text("order ")), form(money, 0.0, lead=F.concat(before, text("$"))), form(money, 0.0, tail=text(" EUR")),
        form(F.concat_ws(".", part(d, 1, 2), part(d, 3, 3), part(d, 6, 3)), 0.0, tail=text(" €")),
        form(day, 0.0), form(F.concat(day, text(" 1"), part(d, 5, 1)), 0.0, tail=text(":30 ")))
    return F.when(kind == "email", email).when(kind == "ip", ip).when(kind == "card", card).otherwise(phone)


def train(docs: DataFrame, text: str = "text", train_rows: int = TRAIN_ROWS, precision: float = PRECISION, trees: int = TREES,
          depth: int = DEPTH, seed: int = SEED) -> Booster:
    """Fit on every candidate and every rewritten span; calibrate on a fifth (by hash) that no tree saw.

    Base spans need no model and are neither trained nor counted on.  They are rewritten in their context, and the
    candidate that a generator finds there is labelled; candidates of the texts are labelled by ``evidence``, or false
    if they touch a base span of another kind.  Without candidates of both sorts there is no model, and no kind adds spans.

    Equal features with equal labels are one row with their number as its weight.  Weights are scaled so that neither
    candidates nor rewritten spans weigh more than about ``train_rows`` together, and neither sort drowns the other.
    """
    t = F.coalesce(F.col(text), F.lit(""))
    around = lambda s: [F.substring(t, F.greatest(s["start"] - BEFORE, F.lit(0)) + 1, s["start"] - F.greatest(s["start"] - BEFORE, F.lit(0))).alias("before"),
                        F.substring(t, s["start"] + 1, s["end"] - s["start"]).alias("value"),
                        F.substring(t, s["end"] + 1, F.lit(2 * AFTER)).alias("after")]
    touched = lambda c, test: F.exists("base", lambda b: (b["start"] < c["end"]) & (c["start"] < b["end"]) & test(b))
    both = F.concat(
        F.transform(candidates(F.col(text)), lambda c: F.struct(
            c["kind"].alias("kind"), *around(c), c["f"].alias("f"), touched(c, lambda b: b["kind"] == c["kind"]).alias("own"),
            touched(c, lambda b: b["kind"] != c["kind"]).alias("other"))),
        F.transform("base", lambda b: F.struct(b["kind"].alias("kind"), *around(b), F.lit(None).cast("array<double>").alias("f"),
                                               F.lit(True).alias("own"), F.lit(False).alias("other"))))
    found = docs.select(F.col(text).alias(text), base_spans(F.col(text)).alias("base")).select(F.explode(both).alias("s")).select("s.*")
    label = F.when(F.col("f").isNull(), 1.0).when(F.col("own"), F.lit(None)).when(F.col("other"), 0.0).otherwise(
        evidence(F.col("kind"), F.col("value"), F.col("f")))
    # Only spans are rewritten, so only theirs is the text that moves on.
    own = lambda c: F.when(F.col("f").isNull(), F.col(c)).alias(c)
    rows = stage(found.withColumn("label", label).where("label IS NOT NULL").select(
        "kind", "f", "label", own("before"), own("value"), own("after"),
        (F.pmod(F.xxhash64("kind", "before", "value", F.lit(seed)), F.lit(5)) == 0).alias("held")), "candidates")
    seen = rows.agg(F.count("f").alias("n"), F.count("*").alias("all")).first()
    scaled = lambda n, each=1: min(1.0, train_rows / max(1, n * each))

    spans = rows.where("f IS NULL").groupBy("kind", "before", "value", "after", "held").agg(F.count("*").alias("n")).select(
        "kind", "held", "n", F.explode(rewritten(F.col("kind"), F.col("before"), F.col("value"), F.col("after"))).alias("r")).where(
        "r.value IS NOT NULL")
    made = spans.select("kind", "held", "n", F.col("r.label").alias("label"), F.length("r.before").alias("start"), F.length("r.value").alias("l"),
                        F.explode(candidates(F.concat("r.before", "r.value", "r.after"))).alias("c")).where(
        (F.col("c.kind") == F.col("kind")) & (F.col("c.start") == F.col("start")) & (F.col("c.end") == F.col("start") + F.col("l")))
    weighed = rows.where("f IS NOT NULL").select("kind", "f", "label", "held", F.lit(scaled(seen["n"])).alias("w")).union(
        made.select("kind", "c.f", "label", "held", F.col("n") * F.lit(scaled(seen["all"] - seen["n"], 10))))
    examples = stage(weighed.groupBy("kind", "f", "label", "held").agg(F.sum("w").alias("w")), "examples")
    fit = examples.where("NOT held").select(array_to_vector("f").alias("features"), "label", "w")
    if fit.select("label").distinct().limit(2).count() < 2:
        return Booster((), (), {})
    model = GBTClassifier(maxIter=trees, maxDepth=depth, seed=seed, cacheNodeIds=False, weightCol="w").fit(fit)
    fitted = Booster(tuple(read_tree(t) for t in model.trees), tuple(model.treeWeights), {})
    scored = examples.where("held").select("kind", "label", "w", F.floor(fitted.score(F.col("f")) * 100).alias("bin"))
    bins = scored.groupBy("kind", "bin").agg(F.sum(F.col("label") * F.col("w")).alias("true"), F.sum("w").alias("n")).collect()  # 101 bins a kind
    thresholds = {}
    for kind in KINDS:
        true = n = 0
        for b in sorted((b for b in bins if b["kind"] == kind), key=lambda b: -b["bin"]):
            true, n = true + b["true"], n + b["n"]
            if true < precision * n:
                break
            thresholds[kind] = b["bin"] / 100
    return Booster(fitted.trees, fitted.weights, thresholds)


def find_personal_data(docs: DataFrame, key: str = "doc_id", text: str = "text", booster: Booster | None = None) -> DataFrame:
    """``key``, ``base`` and ``spans``: arrays of (kind, start, end), by kind as listed, then start, for every input row.

    ``spans`` holds the base spans and what the booster (trained on ``docs`` if none is given) adds.  Null and empty texts
    have empty arrays, null keys stay, repeated rows are done one by one, an empty table gives no rows; other columns are
    neither read nor returned.
    """
    booster = booster or train(docs, text)
    chosen = F.transform(F.filter(candidates(F.col(text)), booster.selects), lambda c: F.struct(c["kind"], c["start"], c["end"])).cast(SPANS)
    return docs.select(F.col(key).alias(key), base_spans(F.col(text)).alias("base"), chosen.alias("chosen")).select(
        key, "base", ordered(F.array_union("base", "chosen")).alias("spans"))


def ordered(spans: Column) -> Column:
    """Spans by kind as listed, then start, then end."""
    rank = lambda s: F.array_position(F.array(*map(F.lit, KINDS)), s["kind"])
    keyed = F.sort_array(F.transform(spans, lambda s: F.struct(rank(s).alias("r"), s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"))))
    return F.transform(keyed, lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end")))


def render(spans: Column) -> Column:
    """``kind:start:end`` of all spans in their order, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def redact(docs: DataFrame, text: str = "text", booster: Booster | None = None) -> DataFrame:
    """``docs`` with every found span replaced by its kind in capitals and brackets; other columns unchanged.

    Of spans that overlap the first gives the kind and all are removed.  A null text stays null.
    """
    booster = booster or train(docs, text)
    t = F.col(f"`{text}`")
    found = F.concat(base_spans(t), F.transform(F.filter(candidates(t), booster.selects), lambda c: F.struct(c["kind"], c["start"], c["end"])).cast(SPANS))
    by_start = F.sort_array(F.transform(found, lambda s: F.struct(s["start"], s["end"], s["kind"])).cast("array<struct<start:int,end:int,kind:string>>"))

    def cut(spans: Column) -> Column:
        reach = F.aggregate(spans, F.array(F.lit(0)), lambda a, s: F.concat(a, F.array(F.greatest(F.element_at(a, -1), s["end"]))))
        return bind(reach, lambda r: F.concat(
            F.array_join(F.transform(spans, lambda s, i: F.when(s["start"] >= F.get(r, i), F.concat(
                F.substring(t, F.get(r, i) + 1, s["start"] - F.get(r, i)), F.lit("["), F.upper(s["kind"]), F.lit("]"))).otherwise("")), ""),
            F.substring(t, F.element_at(r, -1) + 1, F.length(t))))

    spans = free_name(docs, "spans")
    kept = [F.when(F.size(spans) > 0, bind(F.col(spans), cut)).otherwise(t).alias(c) if c == text else F.col(f"`{c}`") for c in docs.columns]
    return docs.withColumn(spans, by_start).select(*kept)

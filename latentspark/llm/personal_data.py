"""Personal data by weak supervision, in Spark SQL functions only.

Base spans (email, ip, card, phone) come from four patterns.  A broader
pattern proposes further candidates (keys and tokens, number groups, spelled
mail addresses); seven labelers (patterns, cue-word gazetteers, context and
shape) vote for, against or abstain on each.  Expectation-maximisation over
the counts of vote patterns (at most 3^7 of them, counted by Spark over all
candidates) estimates how reliable each labeler is; the posteriors weigh a
naive Bayes classifier over span features, whose log-odds become literals of
one Spark expression.  Candidates that it accepts and that overlap no base span
are added; base spans always stay.

Positions are code points, ends exclusive.  A position is the length of what
``split`` leaves before a match plus the matches before it, so each pattern is
run once, and a second time only on texts that have a match.  Possessive
quantifiers and the guards at run starts change no match; they keep long runs
of digits or letters linear.

Edge cases: a null text is empty and has no spans; repeated rows are judged
each on its own; an empty table gives no candidates and so no added spans (the
classifier is then empty); further columns keep their values whatever their
names.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from math import log

from pyspark.sql import Column, DataFrame, functions as F

from latentspark.llm.common import fresh_name

# The base patterns, in the order of their kinds.
EMAIL = r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"[0-9](?:[\x20-]?+[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
KINDS = ("email", "ip", "card", "phone")
PART = r"0*(?:25[0-5]|2[0-4][0-9]|[01]?[0-9]?[0-9])"

#: Proposals of the method: keys (20 or more characters with a digit), number groups, spelled mail addresses.
PROPOSAL = (r"(?<![A-Za-z0-9_+/-])(?=[A-Za-z_+/-]{0,64}[0-9])[A-Za-z0-9_+/-]{20,}+"
            r"|(?<![0-9])[0-9][0-9\x20().-]{7,}[0-9]"
            r"|(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}+ ?[(\[]at[)\]] ?[A-Za-z0-9-]++(?:(?:\.| ?[(\[]dot[)\]] ?)[A-Za-z0-9-]++)++")
EXTRA_KINDS = ("mail", "number", "secret")
CUES = r"(?i)(?:token|secret|passw(?:or)?d|api[_ -]?key|access[_ -]?key|phone|tel|mobile|e-?mail|card|iban|ssn|passport)\W{0,6}$"
ANTI_CUES = r"(?i)(?:version|licen[sc]e|chapter|section|page|figure|isbn|doi|issue|volume)\W{0,4}$"
CONTEXT = 32

SPAN = "struct<s:int,e:int,m:string,l:string>"


def matched(text: Column, pattern: str, guard: Column) -> Column:
    return F.when(guard, F.regexp_extract_all(text, F.lit(pattern), 0)).otherwise(F.array().cast("array<string>"))


def placed(text: Column, matches: Column, pattern: str) -> Column:
    """Matches with their positions and the code points before them, as ``array<struct<s, e, m, l>>``."""
    between = F.slice(F.split(text, pattern, -1), F.lit(1), F.size(matches))
    start = F.struct(F.lit(0).alias("at"), F.array().cast(f"array<{SPAN}>").alias("spans"))

    def step(acc, x):
        s = acc["at"] + F.length(x["before"])
        e = s + F.length(x["m"])
        left = F.substring(text, F.greatest(s - CONTEXT, F.lit(0)) + 1, F.least(s, F.lit(CONTEXT)))
        one = F.struct(s.cast("int").alias("s"), e.cast("int").alias("e"), x["m"].alias("m"), left.alias("l"))
        return F.struct(e.cast("int").alias("at"), F.concat(acc["spans"], F.array(one)).alias("spans"))

    pairs = F.arrays_zip(between.alias("before"), matches.alias("m"))
    return F.when(F.size(matches) > 0, F.aggregate(pairs, start, step, lambda acc: acc["spans"])).otherwise(
        F.array().cast(f"array<{SPAN}>"))


def digits(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]", "")


def luhn(m: Column) -> Column:
    """True for 13 to 19 digits with a right Luhn sum."""
    d = digits(m)
    n = F.length(d)

    def add(acc, i):
        x = F.substring(d, i, F.lit(1)).cast("int")
        twice = F.when(x > 4, 2 * x - 9).otherwise(2 * x)
        return acc + F.when(F.pmod(n - i, F.lit(2)) == 1, twice).otherwise(x)

    return F.when(n.between(13, 19), F.pmod(F.aggregate(F.sequence(F.lit(1), n), F.lit(0), add), F.lit(10)) == 0).otherwise(False)


def good_ip(m: Column) -> Column:
    return m.rlike(rf"^{PART}(?:\.{PART}){{3}}$")


def good_phone(m: Column) -> Column:
    return F.length(digits(m)).between(9, 15)


def with_spans(docs: DataFrame, into: str, text: str = "text") -> DataFrame:
    """``docs`` with a struct ``into``: the base spans of each kind and the proposals ``more``, each with left context."""
    cols = [F.col(f"`{c}`") for c in docs.columns]
    t = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    has_digit = t.rlike("[0-9]")
    raw = docs.select(*cols, F.struct(
        matched(t, EMAIL, t.contains("@")).alias("email"), matched(t, IP, has_digit).alias("ip"),
        matched(t, CARD, has_digit).alias("card"), matched(t, PHONE, t.contains("+")).alias("phone"),
        matched(t, PROPOSAL, has_digit | t.rlike(r"[(\[]at[)\]]")).alias("more")).alias(into))
    pattern = {"email": EMAIL, "ip": IP, "card": CARD, "phone": PHONE, "more": PROPOSAL}
    sited = raw.select(*cols, F.struct(*[placed(t, F.col(f"{into}.{k}"), p).alias(k) for k, p in pattern.items()]).alias(into))
    good = {"ip": good_ip, "card": luhn, "phone": good_phone}

    def passing(kind):
        return F.filter(F.col(f"{into}.{kind}"), lambda x: good[kind](x["m"])).alias(kind)
    base = sited.select(*cols, F.struct(F.col(f"{into}.email").alias("email"), *[passing(k) for k in KINDS[1:]],
                                        F.col(f"{into}.more").alias("more")).alias(into))
    held = F.concat(*[F.col(f"{into}.{k}") for k in KINDS])
    free = F.filter(F.col(f"{into}.more"), lambda c: ~F.exists(held, lambda b: (b["s"] < c["e"]) & (b["e"] > c["s"])))
    return base.select(*cols, F.col(into).withField("more", free).alias(into))


# ------------------------------------------------------------------ labelers, reliabilities, classifier

def kind_of(m: Column) -> Column:
    return F.when(m.rlike(r"[(\[]at[)\]]"), F.lit("mail")).when(m.rlike(r"^[0-9\x20().-]+$"), F.lit("number")).otherwise(F.lit("secret"))


def votes(m: Column, left: Column) -> list[Column]:
    """One vote per labeler: 1 personal, -1 not, 0 abstains."""
    n = F.length(digits(m))
    vote = lambda yes, no=F.lit(False): F.when(yes, 1).when(no, -1).otherwise(0)
    numeric = m.rlike(r"^[0-9\x20().-]+$")
    return [
        vote(m.rlike(r"[(\[]at[)\]]")),                                             # spelled mail address
        vote(luhn(m), numeric & n.between(13, 19)),                                 # card number, or a wrong one
        vote(numeric & m.rlike(r"^\(?0?[1-9][0-9]{1,3}\)?[ .-][0-9]{3}[ .-][0-9]{4}$"), numeric & (n < 7)),  # local phone
        vote(left.rlike(CUES), left.rlike(ANTI_CUES)),                              # gazetteer of cue words
        vote(left.rlike("[=:]\\s?[\"']?$")),                                        # context: a value follows a name
        vote(m.rlike(r"^(?:[0-9a-f]{32,}|[0-9A-F]{32,})$") | m.rlike(r"^(?=.*[a-z])(?=.*[A-Z])(?=.*[0-9])[A-Za-z0-9_+/-]{24,}$"),
             m.rlike(r"^[A-Za-z]+[-_/][A-Za-z0-9_/-]*$")),                          # shape of a random key, or of a slug
        vote(F.lit(False), m.rlike(r"^[0-9]{4}[-./ ][0-9]{1,2}[-./ ][0-9]{1,2}") | m.rlike(r"^([0-9])\1{7,}$")),  # dates, runs
    ]


def features(m: Column, left: Column) -> dict[str, Column]:
    length = F.least(F.floor(F.length(m) / 8), F.lit(8)).cast("string")
    share = F.floor(4 * F.length(digits(m)) / F.length(m)).cast("string")
    return {"kind": kind_of(m), "length": length, "digit_share": share,
            "hex": m.rlike("^[0-9a-f]+$|^[0-9A-F]+$").cast("string"),
            "cue": F.when(left.rlike(CUES), F.lit("cue")).when(left.rlike(ANTI_CUES), F.lit("anti")).otherwise(F.lit("none")),
            "before": F.when(left.rlike("[\"']$"), F.lit("quote")).when(left.rlike("[=:]\\s?$"), F.lit("sign")).when(
                left.rlike("\\s$"), F.lit("space")).otherwise(F.lit("other")),
            "groups": F.least(F.size(F.split(m, "[^A-Za-z0-9]+")), F.lit(5)).cast("string")}


@dataclass
class SpanModel:
    """Log-odds of the span classifier: ``bias`` and per feature value; reliabilities and class prior for inspection."""
    bias: float = float("-inf")
    weights: dict[str, dict[str, float]] = field(default_factory=dict)
    reliabilities: list[dict[int, tuple[float, float]]] = field(default_factory=list)
    prior: float = 0.0

    def accepts(self, m: Column, left: Column) -> Column:
        if not self.weights:
            return F.lit(False)
        score = F.lit(self.bias)
        for name, value in features(m, left).items():
            chain = F
            for v, w in sorted(self.weights[name].items()):
                chain = chain.when(value == v, F.lit(w))
            score = score + chain.otherwise(F.lit(0.0))
        return score > 0


def estimate(patterns: dict[tuple[int, ...], float], rounds: int = 100, smooth: float = 1.0):
    """Expectation-maximisation over vote-pattern counts: (posterior per pattern, reliabilities, prior).

    Votes are independent given the class; the start is the majority vote.
    """
    def start(p):
        return min(max(0.5 + 0.4 * (sum(p) > 0) - 0.4 * (sum(p) < 0) - 0.1 * (sum(p) == 0), 0.05), 0.95)
    post = {p: start(p) for p in patterns}
    n_labelers = len(next(iter(patterns)))
    rel, prior = [], 0.5
    for _ in range(rounds):
        total = sum(patterns.values())
        one = sum(c * post[p] for p, c in patterns.items())
        prior = (one + smooth) / (total + 2 * smooth)
        rel = []
        for k in range(n_labelers):
            table = {}
            for v in (-1, 0, 1):
                a = sum(c * post[p] for p, c in patterns.items() if p[k] == v)
                b = sum(c * (1 - post[p]) for p, c in patterns.items() if p[k] == v)
                table[v] = ((a + smooth) / (one + 3 * smooth), (b + smooth) / (total - one + 3 * smooth))
            rel.append(table)
        new = {}
        for p in patterns:
            odds = log(prior / (1 - prior)) + sum(log(rel[k][v][0] / rel[k][v][1]) for k, v in enumerate(p) if v)
            new[p] = 1 / (1 + 2.718281828459045 ** -max(min(odds, 500), -500))
        moved = max(abs(new[p] - post[p]) for p in patterns)
        post = new
        if moved < 1e-9:
            break
    return post, rel, prior


def learn_spans(docs: DataFrame, smooth: float = 1.0) -> SpanModel:
    """Labeler reliabilities and the span classifier from the proposals of all documents; one counting job.

    What reaches the driver are counts by (vote pattern, feature, value): at
    most 3^7 patterns times some 40 values, whatever the input.
    """
    s = "spans"
    c = F.col("c")
    found = with_spans(docs.select("text"), s).select(F.explode(f"{s}.more").alias("c"))
    voted = found.select(F.concat_ws(",", *[v.cast("string") for v in votes(c["m"], c["l"])]).alias("votes"),
                         F.explode(F.array(*[F.struct(F.lit(k).alias("feature"), v.alias("value"))
                                             for k, v in features(c["m"], c["l"]).items()])).alias("f"))
    rows = voted.groupBy("votes", "f.feature", "f.value").agg(F.count("*").alias("n")).collect()
    if not rows:
        return SpanModel()
    patterns: dict[tuple[int, ...], float] = {}
    for r in rows:
        if r["feature"] == "kind":
            p = tuple(map(int, r["votes"].split(",")))
            patterns[p] = patterns.get(p, 0) + r["n"]
    post, rel, prior = estimate(patterns, smooth=smooth)
    good, bad = {}, {}
    for r in rows:
        w = post[tuple(map(int, r["votes"].split(",")))]
        for side, part in ((good, w), (bad, 1 - w)):
            side.setdefault(r["feature"], {}).setdefault(r["value"], 0.0)
            side[r["feature"]][r["value"]] += part * r["n"]
    one, zero = sum(good["kind"].values()), sum(bad["kind"].values())
    weights = {f: {v: log((good[f][v] + smooth) / (one + smooth * len(good[f])))
                   - log((bad[f][v] + smooth) / (zero + smooth * len(good[f]))) for v in good[f]} for f in good}
    return SpanModel(log((one + smooth) / (zero + smooth)), weights, rel, prior)


# ------------------------------------------------------------------ results

def accepted(docs: DataFrame, model: SpanModel, into: str, text: str = "text") -> DataFrame:
    """``with_spans`` with ``more`` reduced to the proposals that the classifier accepts."""
    cols = [F.col(f"`{c}`") for c in docs.columns]
    more = F.filter(F.col(f"{into}.more"), lambda c: model.accepts(c["m"], c["l"]))
    return with_spans(docs, into, text).select(*cols, F.col(into).withField("more", more).alias(into))


def listed(spans: Column, kind: str) -> Column:
    return F.transform(spans, lambda c: F.concat_ws(":", F.lit(kind), c["s"].cast("string"), c["e"].cast("string")))


def span_report(docs: DataFrame, model: SpanModel) -> DataFrame:
    """``doc_id``, counts of the base kinds, digest of the base spans and the list of all spans."""
    x = accepted(docs.select("doc_id", "text"), model, "p")
    base = F.concat(*[listed(F.col(f"p.{k}"), k) for k in KINDS])

    def of_kind(kind):
        return listed(F.filter("p.more", lambda c: kind_of(c["m"]) == kind), kind)

    extra = F.concat(*[of_kind(k) for k in EXTRA_KINDS])
    return x.select("doc_id", *[F.size(f"p.{k}").cast("long").alias(f"n_{k}") for k in KINDS],
                    F.sha2(F.array_join(base, ","), 256).alias("base_sha256"),
                    F.array_join(F.concat(base, extra), ",").alias("spans"))


def redact(docs: DataFrame, model: SpanModel) -> DataFrame:
    """``docs`` with every span of ``text`` replaced by its kind, ``<EMAIL>`` and so on; columns unchanged.

    Overlapping spans become one tag, that of the span which starts first (longest on ties).  A null text stays null.
    """
    s = fresh_name(docs, "pii_spans")
    x = accepted(docs, model, s)
    tagged = lambda k: F.transform(F.col(f"{s}.{k}"), lambda c: F.struct(
        c["s"].alias("s"), (-c["e"]).alias("e"), (F.upper(kind_of(c["m"])) if k == "more" else F.lit(k.upper())).alias("k")))
    every = F.array_sort(F.concat(*[tagged(k) for k in (*KINDS, "more")]))
    t = F.col("text")

    def step(acc, c):
        fresh = F.concat(acc["out"], F.substring(t, acc["at"] + 1, c["s"] - acc["at"]), F.lit("<"), c["k"], F.lit(">"))
        return F.struct(F.greatest(acc["at"], -c["e"]).alias("at"), F.when(c["s"] >= acc["at"], fresh).otherwise(acc["out"]).alias("out"))

    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
    clean = F.aggregate(every, start, step, lambda acc: F.concat(acc["out"], F.substring(t, acc["at"] + 1, F.length(t))))
    return x.select(*[F.when(F.size(every) > 0, clean).otherwise(t).alias(c) if c == "text" else F.col(f"`{c}`") for c in docs.columns])

"""Personal data by candidate gradient boosting, with DataFrame and SQL functions alone.

High-recall generators propose overlapping spans (wide patterns for mail,
digit groups, addresses and accounts). Each candidate has a few whole-number
features of its format (digits, separators, groups, checksum) and context (cue
words before it, its neighbours). Boosted trees give it a probability; it is
redacted if that reaches its kind's threshold, calibrated so that of the
candidates above it on held-back labelled samples PRECISION at least are true.
The trees are a SQL expression, so scoring stays in the JVM.

Base spans are what the fixed patterns of email, ip, card and phone find; they
always stand. A candidate stands only where it overlaps no base span; of
candidates that overlap, taken by start, the likelier stands. Spans are
kind:start:end in code points, the end exclusive. All passes over a text's spans
are linear, so long and dense texts cost by their length.

The trees are trained here, from labelled samples that a rule with a seed makes
(SAMPLES texts); the same SQL that scans documents finds their candidates and
features.
"""

from __future__ import annotations

import json
import random

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed patterns, written so that no run of characters is tried from each of its places.
LOCAL, HOST = "[A-Za-z0-9._%+-]", "[A-Za-z0-9-]"
BASE = {
    "email": rf"(?:\G|(?<!{LOCAL})){LOCAL}++@{HOST}++(?:\.{HOST}++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[ -]?[0-9])++",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}
#: What stands for the sign in an address that is spelled out.
AT = r"@|[\[(] ?(?:at|AT) ?[\])]| at | AT "
#: Candidate generators, named by kind; several may propose the same digits. KINDS is the order of the spans.
WIDE = {
    "email": rf"(?:\G|(?<!{LOCAL})){LOCAL}++ ?(?:{AT}) ?{HOST}++(?: ?(?:\.|[\[(] ?(?:dot|DOT) ?[\])]| dot | DOT ) ?{HOST}++)++",
    "ip": r"(?<![0-9A-Fa-f:])(?:[0-9A-Fa-f]{1,4}:){4,7}[0-9A-Fa-f]{1,4}(?![0-9A-Fa-f:])",
    "card": r"(?<![0-9])[0-9]{4}(?:[ .-]?[0-9]{2,6}){2,4}(?![0-9])",
    "phone": r"(?<![0-9.])\(?[0-9]{2,5}\)?(?:[ .-]?[0-9]{2,5}){2,5}(?![0-9])",
    "iban": r"(?<![A-Z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Z0-9])",
    "ssn": r"(?<![0-9-])[0-9]{3}[- ][0-9]{2}[- ][0-9]{4}(?![0-9-])",
    "card_whole": r"(?<![0-9])[0-9]{13,19}(?![0-9])",
}
KINDS = ["email", "ip", "card", "phone", "iban", "ssn"]
# Fixed cue words.
CUES = {
    1: "phone|tel|call|mobile|cell|fax|whatsapp|telefon|téléphone|teléfono|anrufen|contact",
    2: "card|visa|mastercard|amex|credit|debit|karte|carte|tarjeta",
    3: "ssn|social security|iban|account|konto|compte|cuenta|passport|tax id",
    4: "mail|write to|e-mail|correo|courriel|reach me",
    5: "order|invoice|version|isbn|ref|serial|sku|ticket|page|total|price|tracking|build|item|code|nr|time|score",
}
FEATURES = ["kind", "digits", "seps", "groups", "luhn", "cue", "before", "after", "len", "kinds_of_digits", "lead", "at"]
SAMPLES, TREES, DEPTH, RATE, PRECISION = 12_000, 40, 3, 0.3, 0.97
#: Elements that a scan gathers at a time, characters of the segments of texts, and those kept before a candidate.
STEP, SEGMENT, CONTEXT = 128, 4096, 28
SPAN = "struct<s:int,e:int,t:string,b:string,a:string>"
ITEM = "struct<s:int,e:int,base:int,kind:int,t:string,b:string,a:string>"
KEPT = "struct<k:int,s:int,e:int,o:double>"


def raw(pattern: str) -> str:
    return "r'" + pattern + "'"


def finds(text: str, pattern: str, when: str) -> str:
    """SQL: all matches with what stands between them, where `when` holds; the pieces around n matches are n + 1."""
    p = raw(pattern)
    return f"if({when}, named_struct('m', regexp_extract_all({text}, {p}, 0), 'p', split({text}, {p}, -1)), named_struct('m', cast(array() as array<string>), 'p', cast(array() as array<string>)))"


def scan(array: str, start: str, after: str, emit: str, state: str, item: str) -> str:
    """SQL: what `emit` makes of each element x and the state acc.z before it; `after` is the state after it.

    An aggregation copies what it has gathered at each step, so elements go in chunks of STEP: one pass finds the state
    at the start of every chunk, a second one emits from there.
    """
    chunks = f"transform(sequence(0, greatest(size(v) - 1, 0) div {STEP}), i -> slice(v, cast(i * {STEP} + 1 as int), {STEP}))"
    states = f"""aggregate(w, named_struct('z', cast({start} as {state}), 'o', cast(array() as array<{state}>)),
      (o, c) -> named_struct('z', aggregate(c, named_struct('z', o.z), (acc, x) -> named_struct('z', {after}), acc -> acc.z), 'o', concat(o.o, array(o.z))), o -> o.o)"""
    emitted = f"""flatten(zip_with(w, {states}, (c, q) -> aggregate(c, named_struct('z', q, 'out', cast(array() as array<{item}>)),
      (acc, x) -> named_struct('z', {after}, 'out', concat(acc.out, array({emit}))), acc -> acc.out)))"""
    return f"transform(array({array}), v -> transform(array({chunks}), w -> {emitted})[0])[0]"


def spans_of(found: str) -> str:
    """SQL: (start, end, match, what stands before it, the character after it) of the matches in `found`, by adding up lengths."""
    m, p = f"{found}.m", f"{found}.p"
    each = f"""transform({m}, (t, i) -> named_struct('t', t, 'g', length({p}[i]), 'n', length(t),
      'b', right(concat(coalesce(right(get({m}, i - 1), {CONTEXT}), ''), right({p}[i], {CONTEXT})), {CONTEXT}),
      'a', if({p}[i + 1] = '', coalesce(left(get({m}, i + 1), 1), ''), left({p}[i + 1], 1))))"""
    return scan(each, "0", "acc.z + x.g + x.n", "named_struct('s', acc.z + x.g, 'e', acc.z + x.g + x.n, 't', x.t, 'b', x.b, 'a', x.a)", "int", SPAN)


def digits_of(t: str) -> str:
    return f"regexp_replace({t}, '[^0-9]', '')"


def luhn(digits: str) -> str:
    """SQL: whether a string of digits passes; from the right, every second digit doubles."""
    return f"""aggregate(transform(split(reverse({digits}), ''), (c, i) -> if(i % 2 = 0, coalesce(try_cast(c as int), 0), 2 * coalesce(try_cast(c as int), 0) - if(coalesce(try_cast(c as int), 0) > 4, 9, 0))), 0, (a, x) -> a + x) % 10 = 0"""


#: SQL: whether a match of a base pattern counts.
VALID = {
    "email": "true",
    "ip": r"forall(split(x.t, r'\.'), p -> length(ltrim('0', p)) <= 3 and coalesce(try_cast(ltrim('0', p) as int), 0) <= 255)",
    "card": f"length({digits_of('x.t')}) between 16 and 19 and {luhn(digits_of('x.t'))}",
    "phone": f"length({digits_of('x.t')}) between 8 and 15",
}
#: SQL: a condition on the text without which a pattern can't match; it spares most texts the search.
NEEDS = {
    "email": "contains(text, '@')",
    "ip": "digit",
    "card": "digit",
    "phone": "contains(text, '+') and digit",
}
WIDE_NEEDS = {
    "email": f"regexp_like(text, {raw(AT)})",  # a part of the pattern itself
    "ip": "digit and contains(text, ':')",
    "card": "digit",
    "phone": "digit",
    "iban": "digit",
    "ssn": "digit",
    "card_whole": "digit",
}


def features_sql() -> str:
    """SQL: the features of candidate x."""
    before = "lower(x.b)"
    cue = "case " + " ".join(f"when regexp_like({before}, r'(?:^|[^a-z])(?:{w})[^a-z]*(?:[a-z]+[^a-z]+)?$') then {k}" for k, w in CUES.items()) + " else 0 end"
    d = digits_of("x.t")
    return f"""named_struct('s', x.s, 'e', x.e, 'kind', x.kind,
      'digits', least(length({d}), 40),
      'seps', length(regexp_replace(x.t, '[0-9A-Za-z]', '')),
      'groups', size(split(x.t, '[^0-9]+')),
      'luhn', cast({luhn(d)} as int),
      'cue', {cue},
      'before', case when x.s = 0 then 0 when regexp_like(right(x.b, 1), r'[\\p{{L}}\\p{{N}}#$€£=/_.-]') then 2 else 1 end,
      'after', case when x.a = '' then 0 when regexp_like(x.a, r'[\\p{{L}}\\p{{N}}%$€£=/_-]') then 2 else 1 end,
      'len', least(x.e - x.s, 80),
      'kinds_of_digits', size(array_distinct(split({d}, ''))),
      'lead', case when substring(x.t, 1, 1) = '0' then 1 when substring(x.t, 1, 1) = '(' then 2 when substring(x.t, 1, 1) in ('3', '4', '5', '6') then 3 else 0 end,
      'at', case when regexp_like(lower(x.t), r'[\\[(] ?(at|dot) ?[\\])]') or contains(x.t, ' DOT ') then 2 when contains(lower(x.t), ' dot ') then 1 else 0 end)"""


def clear_of_base() -> str:
    """SQL: the candidates of `wide` that overlap no span of `base`: one pass sees the bases that begin before, one those after."""
    items = "array_sort(concat(transform(base, x -> cast(named_struct('s', x.s, 'e', x.e, 'base', 1, 'kind', x.k, 't', '', 'b', '', 'a', '') as " + ITEM + ")), wide))"
    forth = scan(items, "0", "if(x.base = 1, greatest(acc.z, x.e), acc.z)", "if(x.base = 1 or acc.z <= x.s, x, null)", "int", ITEM)
    back = scan(f"reverse(filter({forth}, x -> x is not null))", "2147483647", "if(x.base = 1, least(acc.z, x.s), acc.z)", "if(x.base = 0 and acc.z >= x.e, x, null)", "int", ITEM)
    return f"if(size(base) = 0 or size(wide) = 0, wide, filter({back}, x -> x is not null))"


def candidates(docs: DataFrame) -> DataFrame:
    """row (a struct of the columns of docs), text (null: empty), base (spans of each base kind), cands (features of candidates)."""
    df = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    df = df.withColumn("digit", F.col("text").rlike("[0-9]"))
    df = df.withColumns({f"b_{k}": F.expr(finds("text", p, NEEDS[k])) for k, p in BASE.items()} | {f"w_{k}": F.expr(finds("text", p, WIDE_NEEDS[k])) for k, p in WIDE.items()})
    df = df.withColumns({f"b_{k}": F.expr(f"filter({spans_of(f'b_{k}')}, x -> {VALID[k]})") for k in BASE} | {f"w_{k}": F.expr(spans_of(f"w_{k}")) for k in WIDE})
    base = ", ".join(f"transform(b_{k}, x -> named_struct('k', {i}, 's', x.s, 'e', x.e))" for i, k in enumerate(BASE))
    wide = ", ".join(f"transform(w_{k}, x -> cast(named_struct('s', x.s, 'e', x.e, 'base', 0, 'kind', {KINDS.index(k.split('_')[0])}, 't', x.t, 'b', x.b, 'a', x.a) as {ITEM}))" for k in WIDE)
    df = df.select("row", "text", F.expr(f"concat({base})").alias("base"), F.expr(f"concat({wide})").alias("wide"))
    df = df.withColumn("clear", F.expr(clear_of_base()))
    return df.select("row", "text", "base", F.expr(f"transform(clear, x -> {features_sql()})").alias("cands"))


# --- labelled samples ------------------------------------------------------------------------------------------


def sample(rng: random.Random) -> tuple[str, int, int, int]:
    """(text, start, end, the kind of personal data that start..end is, -1 for none)."""
    words = "the a of for and please now here from under your our last new is was to und der la le el les des".split()
    d = lambda n: "".join(rng.choices("0123456789", k=n))
    name = lambda: "".join(rng.choices("abcdefghijklmnoprstuvw", k=rng.randint(3, 8)))
    cue = lambda k: rng.choice(CUES[k].split("|")) + rng.choice([" ", ": ", " is ", " = "])
    sep = rng.choice([" ", "-", "."])
    kind = rng.randrange(16)
    before, after = "", ""
    truth = KINDS.index(("email", "phone", "card", "card", "iban", "ssn", "ip", "phone")[kind]) if kind < 8 else -1
    if kind == 0:
        a, b = rng.choice([(" [at] ", " [dot] "), ("(at)", "(dot)"), (" at ", " dot "), (" (at) ", "."), (" AT ", " DOT ")])
        span, before = f"{name()}.{name()}{a}{name()}{b}com", cue(4) if rng.random() < 0.5 else ""
    elif kind == 1:
        span, before = rng.choice([f"({d(3)}) {d(3)}-{d(4)}", f"{d(3)}{sep}{d(3)}{sep}{d(4)}", f"0{d(rng.randint(2, 4))} {d(rng.randint(5, 8))}", f"0{d(1)} {d(2)} {d(2)} {d(2)} {d(2)}"]), cue(1) if rng.random() < 0.7 else ""
    elif kind == 2:
        span, before = sep.join([d(4), d(4), d(4), d(4)]) if rng.random() < 0.4 else d(16), cue(2) if rng.random() < 0.5 else ""
    elif kind == 3:
        span, before = rng.choice(["34", "37"]) + f"{d(2)} {d(6)} {d(5)}", cue(2) if rng.random() < 0.6 else ""
    elif kind == 4:
        groups = [d(4) for _ in range(rng.randint(3, 5))]
        span, before = rng.choice(["DE", "FR", "ES", "GB"]) + d(2) + rng.choice([" ", ""]).join(["", *groups]) + d(2), cue(3) if rng.random() < 0.5 else ""
    elif kind == 5:
        span, before = f"{d(3)}-{d(2)}-{d(4)}", cue(3) if rng.random() < 0.6 else ""
    elif kind == 6:
        span = ":".join("".join(rng.choices("0123456789abcdef", k=rng.randint(1, 4))) for _ in range(8))
    elif kind == 7:
        span, before = f"{d(3)} {d(3)} {d(rng.randint(3, 4))}", cue(1)
    elif kind == 8:
        span, before = rng.choice([d(rng.randint(6, 14)), f"{d(4)}-{d(6)}"]), cue(5)
    elif kind == 9:
        span, before = f"20{d(2)}-{d(2)}-{d(2)} {d(2)}.{d(2)}.{d(2)}", rng.choice(["on ", "at ", "since ", ""])
    elif kind == 10:
        span, after = ".".join(d(rng.randint(1, 3)) for _ in range(rng.randint(3, 5))), " release"
        before = cue(5)
    elif kind == 11:
        span, before, after = f"{d(3)}.{d(3)}.{d(3)}", rng.choice(["€", "$", "= "]), rng.choice(["€", "%", " units", " km"])
    elif kind == 12:
        span, before = f"978-{d(1)}-{d(4)}-{d(4)}-{d(1)}", "isbn "
    elif kind == 13:
        a, b = name(), name()
        span = f"{a} at {b} dot {name()}" if rng.random() < 0.2 else f"{d(2)} {d(2)} {d(2)}"
        before = rng.choice(["look ", "scores ", "rows "])
    elif kind == 14:
        span, before = "".join(rng.choices("ABCDEFGHKLMNP", k=2)) + d(2) + " " + " ".join("".join(rng.choices("ABCDEFGHKLMNP", k=4)) for _ in range(3)), rng.choice(["model ", "serial "])
    else:
        span, before, after = d(rng.randint(20, 30)), rng.choice(["/", "_", "=", "x"]), rng.choice(["", "/", "_"])
    lead = " ".join(rng.choices(words, k=rng.randint(0, 6)))
    lead += " " if lead and not before.startswith(("/", "_", "=")) else ""
    text = lead + before + span + after + " " + " ".join(rng.choices(words, k=rng.randint(0, 5)))
    return text, len(lead + before), len(lead + before + span), truth


# --- boosted trees ---------------------------------------------------------------------------------------------


def grow(x: np.ndarray, g: np.ndarray, h: np.ndarray, depth: int, penalty: float = 1.0) -> dict:
    """A regression tree on gradients: {'v': value} or {'f': feature, 't': threshold, 'l': left (<= t), 'r': right}."""
    best, parent = None, g.sum() ** 2 / (h.sum() + penalty)
    for f in range(x.shape[1]) if depth else ():
        for t in np.unique(x[:, f])[:-1].tolist():
            left = x[:, f] <= t
            gl, hl = g[left].sum(), h[left].sum()
            if min(hl, h.sum() - hl) < 1.0:
                continue
            gain = gl**2 / (hl + penalty) + (g.sum() - gl) ** 2 / (h.sum() - hl + penalty) - parent
            if gain > 1e-6 and (best is None or gain > best[0]):
                best = gain, f, t, left
    if best is None:
        return {"v": float(-g.sum() / (h.sum() + penalty))}
    _, f, t, left = best
    return {"f": f, "t": int(t), "l": grow(x[left], g[left], h[left], depth - 1, penalty), "r": grow(x[~left], g[~left], h[~left], depth - 1, penalty)}


def value(tree: dict, x: np.ndarray) -> np.ndarray:
    if "v" in tree:
        return np.full(len(x), tree["v"])
    return np.where(x[:, tree["f"]] <= tree["t"], value(tree["l"], x), value(tree["r"], x))


def boost(x: np.ndarray, y: np.ndarray, trees: int = TREES, depth: int = DEPTH, rate: float = RATE) -> tuple[float, list[dict]]:
    """(constant, trees) of a logistic model of log odds."""
    constant = float(np.log((y.sum() + 1) / (len(y) - y.sum() + 1)))
    odds, made = np.full(len(y), constant), []
    for _ in range(trees):
        p = 1 / (1 + np.exp(-odds))
        tree = grow(x, p - y, p * (1 - p), depth)
        _scale(tree, rate)
        odds += value(tree, x)
        made.append(tree)
    return constant, made


def _scale(tree: dict, rate: float) -> None:
    if "v" in tree:
        tree["v"] *= rate
    else:
        _scale(tree["l"], rate)
        _scale(tree["r"], rate)


def tree_sql(tree: dict, names: list[str] = FEATURES) -> str:
    if "v" in tree:
        return f"{tree['v']:.9f}D"
    return f"if(x.{names[tree['f']]} <= {tree['t']}, {tree_sql(tree['l'], names)}, {tree_sql(tree['r'], names)})"


class Model:
    def __init__(self, constant: float, trees: list[dict], thresholds: list[float]):
        self.constant, self.trees, self.thresholds = constant, trees, thresholds

    def odds(self, x: np.ndarray) -> np.ndarray:
        return self.constant + sum(value(t, x) for t in self.trees)

    def odds_sql(self) -> str:
        return " + ".join([f"{self.constant:.9f}D", *map(tree_sql, self.trees)])

    def threshold_sql(self) -> str:
        return f"array({', '.join(f'{t:.9f}D' for t in self.thresholds)})[x.kind]"


def labelled(spark: SparkSession, samples: int = SAMPLES, seed: int = 7) -> list[tuple[bool, np.ndarray, np.ndarray]]:
    """(whether it is for calibration, candidates' features, labels) for two parts of the samples."""
    rng = random.Random(seed)
    made = [sample(rng) for _ in range(samples)]
    rows = json.dumps([{"i": i, "text": t, "a": a, "b": b, "truth": g} for i, (t, a, b, g) in enumerate(made)], ensure_ascii=False)
    texts = spark.range(1, numPartitions=1).select(F.inline(F.from_json(F.lit(rows), "array<struct<i:int,text:string,a:int,b:int,truth:int>>")))
    found = candidates(texts).select("row.*", F.explode("cands").alias("x")).select("i", "a", "b", "truth", "x.*").collect()
    x = np.array([[r[f] for f in FEATURES] for r in found], np.int64)
    y = np.array([r.kind == r.truth and 2 * (min(r.e, r.b) - max(r.s, r.a)) >= max(r.e, r.b) - min(r.s, r.a) for r in found], np.float64)
    held = np.array([r.i % 3 == 0 for r in found])
    return [(False, x[~held], y[~held]), (True, x[held], y[held])]


def thresholds(odds: np.ndarray, kind: np.ndarray, y: np.ndarray, precision: float = PRECISION) -> list[float]:
    """For each kind the least log odds at and above which `precision` of the candidates are true; infinite if none is."""
    out = []
    for k in range(len(KINDS)):
        mine = np.flatnonzero(kind == k)
        mine = mine[np.argsort(-odds[mine], kind="stable")]
        good = np.cumsum(y[mine]) / (np.arange(len(mine)) + 1)
        last = np.append(np.diff(odds[mine]) != 0, True) if len(mine) else np.empty(0, bool)
        ok = np.flatnonzero((good >= precision) & last)
        out.append(float(odds[mine[ok[-1]]]) if len(ok) else 1e9)
    return out


_MODELS: dict[tuple, Model] = {}


def train(spark: SparkSession, samples: int = SAMPLES, seed: int = 7) -> Model:
    key = (samples, seed)
    if key not in _MODELS:
        (_, x, y), (_, xc, yc) = labelled(spark, samples, seed)
        constant, trees = boost(x, y)
        model = Model(constant, trees, [])
        model.thresholds = thresholds(model.odds(xc), xc[:, 0], yc)
        _MODELS[key] = model
    return _MODELS[key]


# --- the operators ---------------------------------------------------------------------------------------------


def detect(docs: DataFrame, model: Model | None = None) -> DataFrame:
    """row (a struct of the columns of docs), text (null: empty), base, found (the model's spans); both array<struct<k,s,e>>, k an index of KINDS."""
    model = model or train(docs.sparkSession)
    df = candidates(docs)
    scored = f"filter(transform(cands, x -> named_struct('s', x.s, 'e', x.e, 'k', x.kind, 'o', {model.odds_sql()}, 'c', {model.threshold_sql()})), x -> x.o >= x.c)"
    df = df.select("row", "text", "base", F.expr(f"if(size(cands) = 0, null, array_sort({scored}))").alias("likely"))
    swept = scan(
        f"concat(transform(likely, x -> cast(named_struct('k', x.k, 's', x.s, 'e', x.e, 'o', x.o) as {KEPT})), array(cast(named_struct('k', -1, 's', 2147483647, 'e', 2147483647, 'o', 0.0D) as {KEPT})))",
        "named_struct('k', -1, 's', -1, 'e', -1, 'o', 0.0D)",
        "if(x.s < acc.z.e and x.o <= acc.z.o, acc.z, x)",
        "if(x.s < acc.z.e, null, acc.z)",
        KEPT,
        KEPT,
    )
    none = "cast(array() as array<struct<k:int,s:int,e:int>>)"
    found = f"if(size(likely) > 0, transform(filter({swept}, x -> x is not null and x.k >= 0), x -> named_struct('k', x.k, 's', x.s, 'e', x.e)), {none})"
    return df.select("row", "text", "base", F.expr(found).alias("found"))


def joined(spans: str) -> str:
    names = ", ".join(f"'{k}'" for k in KINDS)
    return f"array_join(transform(array_sort({spans}), x -> concat(array({names})[x.k], ':', x.s, ':', x.e)), ',')"


def report(docs: DataFrame, model: Model | None = None) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone (base spans), base_sha256, spans, n_found (the model's), for every document.

    Spans are sorted by kind, then start. A null text counts as empty. Repeated rows and null ids stay.
    """
    df = detect(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), model)
    counts = [F.expr(f"cast(size(filter(base, x -> x.k = {i})) as bigint)").alias(f"n_{k}") for i, k in enumerate(BASE)]
    return df.select("row.doc_id", *counts, F.sha2(F.expr(joined("base")), 256).alias("base_sha256"), F.expr(joined("concat(base, found)")).alias("spans"), F.size("found").cast("long").alias("n_found"))


def part(a: str, b: str) -> str:
    """SQL: characters a to b (exclusive) of the text whose segments are `segs`."""
    first, last = f"cast({a} div {SEGMENT} as int)", f"cast(({b} - 1) div {SEGMENT} as int)"
    return f"""case when {b} <= {a} then '' when {first} = {last} then substring(segs[{first}], {a} % {SEGMENT} + 1, {b} - {a})
      else concat(substring(segs[{first}], {a} % {SEGMENT} + 1), array_join(slice(segs, {first} + 2, {last} - {first} - 1), ''), substring(segs[{last}], 1, ({b} - 1) % {SEGMENT} + 1)) end"""


def redact(docs: DataFrame, model: Model | None = None) -> DataFrame:
    """docs with every span of text replaced by its kind in brackets; spans that overlap become one. A null text stays null.

    All columns are carried, whatever their names.
    """
    df = detect(docs, model)
    tags = ", ".join(f"'[{k.upper()}]'" for k in KINDS)
    spans = "array_sort(transform(concat(base, found), x -> named_struct('s', x.s, 'e', x.e, 'k', x.k)))"
    df = df.select("row", "text", F.expr(f"if(size(base) + size(found) = 0, null, {spans})").alias("spans"))
    df = df.withColumn("segs", F.expr(f"if(spans is null, null, regexp_extract_all(text, r'(?s).{{1,{SEGMENT}}}', 0))"))
    shown = scan("spans", "0", "greatest(acc.z, x.e)", f"if(x.s >= acc.z, concat({part('acc.z', 'x.s')}, array({tags})[x.k]), '')", "int", "string")
    end = "array_max(transform(spans, x -> x.e))"
    made = F.expr(f"if(spans is null, text, concat(array_join({shown}, ''), {part(end, 'length(text)')}))")
    return df.select(*[F.when(F.col("row.text").isNotNull(), made).alias(c) if c == "text" else F.col(f"row.`{c}`").alias(c) for c in docs.columns])

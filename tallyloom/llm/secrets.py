"""Secret scan: fixed patterns, and a battery of randomness tests on long runs of symbols.

A run gets an encoding (hex, base32, base36, base62, base64) from the kinds of its symbols.
Separators may be symbols of base64 or stand between symbols, so a run with some is tested
both ways, and so are its long parts between them; of nested spans that pass the longest is
told. The battery asks whether a run looks drawn at random from that alphabet: chi-squared for even use of the symbols, a
runs test about the middle of the alphabet, and the serial correlation of neighbours. The
other side is a null model of names: words, humps (a capital and small letters), groups of
digits and path parts start seldom, and letters come as they do in words, vowels after
consonants. Both p-values go through false-discovery control within classes of length, over
all runs of the corpus, each run once: the battery's decides which runs are not random (a
run with many parts is dismissed only with all of them), the names' which are no names (the
smallest of a run's parts counts, times their number). P-values are binned, so that the
control needs a table of classes times bins only.

Spans are small rows keyed by document. Defined results: a null or empty text has no
spans; repeated rows get the same result each; a text of any length is read whole, in one
task; an empty table gives an empty result.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.llm.common import let, same, text_of
from tallyloom.sources.stage import stage

# Kinds, their patterns, and the length a match needs.
ASSIGN = r"""(?i)(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?[A-Za-z0-9+/_.=-]+"""
ASSIGN_VALUE = r"""(?i)^(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)$"""
KINDS = (
    ("assign", ASSIGN, 6),
    ("access", "AKIA[A-Z0-9]+", 20),
    ("hex", "[0-9a-f]{24,}", 24),
    ("random", "[A-Za-z0-9+/_-]{20,}={0,2}", 20),
)
UUID = "[0-9A-Fa-f]{8}(?:-[0-9A-Fa-f]{4}){3}-[0-9A-Fa-f]{12}"
# Parts of a run: between slashes, then with underscores too, then with hyphens too; and ids in hyphened hex.
PARTS = ("[^+/=]{20,}", "[^+/=_]{20,}", "[^+/=_-]{20,}", UUID)
LEAST_SYMBOLS = 20
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"
UPPER, LOWER, DIGITS = ALPHABET[:26], ALPHABET[26:52], ALPHABET[52:62]
# Encoding, pattern, symbols in order; the first that fits. Case does not tell hex symbols apart.
ENCODINGS = (
    ("hex", "^(?:[0-9a-f]+|[0-9A-F]+)$", DIGITS + "abcdef"),
    ("base32", "^[A-Z2-7]+$", UPPER + "234567"),
    ("base32 lower", "^[a-z2-7]+$", LOWER + "234567"),
    ("base36", "^[A-Z0-9]+$", UPPER + DIGITS),
    ("base36 lower", "^[a-z0-9]+$", LOWER + DIGITS),
    ("base62", "^[A-Za-z0-9]+$", ALPHABET[:62]),
    ("base64", "", ALPHABET),
)
FALSE_DISCOVERIES = 0.01  # of the runs told as random
FALSE_DISMISSALS = 0.001  # of the runs the battery calls not random
# Letters of English text, in hundredths.
LETTERS = dict(
    a=8.2, b=1.5, c=2.8, d=4.3, e=12.7, f=2.2, g=2.0, h=6.1, i=7.0, j=0.15, k=0.77, l=4.0, m=2.4, n=6.7, o=7.5, p=1.9,
    q=0.095, r=6.0, s=6.3, t=9.1, u=2.8, v=0.98, w=2.4, x=0.15, y=2.0, z=0.074,
)
VOWELS = "aeiou"
# Names: chance of a vowel at the start of a word, after a vowel and after a consonant; of a letter that
# follows no rule; and of a new word, hump or group of digits between neighbours.
NAME_VOWEL = (0.30, 0.17, 0.52)
NAME_ODD, NAME_STEP = 0.1, 0.19
BINS, LONGEST_CLASS = 150, 12


def matches(texts: DataFrame) -> DataFrame:
    """(doc_id, text_hash, kind, no, start, end, hit): leftmost matches, long enough, code points, end exclusive."""
    kinds = F.array(
        *[
            F.struct(F.lit(i).alias("no"), F.lit(k).alias("kind"), F.lit(p).alias("pattern"), F.lit(n).alias("least"))
            for i, (k, p, n) in enumerate(KINDS)
        ]
    )
    # `outer` keeps Spark from running the patterns beforehand to find texts without a match
    tried = texts.select(
        "text", "doc_id", F.xxhash64("text").alias("text_hash"),
        F.explode_outer(F.filter(kinds, lambda k: F.rlike(F.col("text"), k["pattern"]))).alias("k"),
    ).where(F.col("k").isNotNull())
    lazy = lambda group: F.concat(F.lit(group), F.col("k.pattern"), F.lit(")"))
    found = tried.select(
        "doc_id", "text_hash", "k.kind", "k.no", "k.least",
        F.transform(F.regexp_extract_all("text", lazy(r"(?s)\G(.*?)(?:"), F.lit(1)), F.char_length).alias("gap"),
        F.regexp_extract_all("text", lazy(r"(?s)\G.*?("), F.lit(1)).alias("hit"),
    )
    rows = found.select(
        "doc_id", "text_hash", "kind", "no", "least", F.posexplode(F.arrays_zip("gap", "hit")).alias("i", "at")
    ).distinct()  # repeated rows make the same matches
    upto = Window.partitionBy("doc_id", "text_hash", "no").orderBy("i")
    end = F.sum(F.col("at.gap") + F.char_length("at.hit")).over(upto)
    value = F.when(F.col("kind") == "assign", F.regexp_extract("hit", ASSIGN_VALUE, 1)).otherwise(F.col("hit"))
    return (
        rows.select(
            "doc_id", "text_hash", "kind", "no", "least",
            (end - F.char_length("at.hit")).alias("start"), end.alias("end"), F.col("at.hit").alias("hit"),
        )
        .where(F.char_length(value) >= F.col("least"))
        .drop("least")
    )


def with_parts(runs: DataFrame) -> DataFrame:
    """The runs and their parts, each once; `bare` rows have the symbols between the separators only.

    `run` and `run_size` are the start and length of the run that a part belongs to.
    """
    runs = runs.withColumn("run", F.col("start")).withColumn("run_size", F.char_length("hit"))
    split = F.rlike("hit", F.lit("[+/_-]"))
    tried = runs.select("*", F.explode(F.array(*[F.lit(p) for p in PARTS])).alias("_part")).where(split)
    lazy = lambda group: F.concat(F.lit(group), F.col("_part"), F.lit(")"))
    cut = tried.select(
        *runs.columns, "_part",
        F.posexplode(
            F.arrays_zip(
                F.transform(F.regexp_extract_all("hit", lazy(r"\G(.*?)(?:"), F.lit(1)), F.char_length).alias("gap"),
                F.regexp_extract_all("hit", lazy(r"\G.*?("), F.lit(1)).alias("piece"),
            )
        ).alias("_i", "_at"),
    )
    upto = Window.partitionBy("doc_id", "text_hash", "start", "_part").orderBy("_i")
    size = F.char_length("_at.piece")
    pieces = cut.withColumn("_end", F.col("start") + F.sum(F.col("_at.gap") + size).over(upto)).select(
        *[c for c in runs.columns if c not in ("start", "end", "hit")],
        (F.col("_end") - size).alias("start"), F.col("_end").alias("end"), F.col("_at.piece").alias("hit"),
    )
    every = runs.unionByName(pieces.select(*runs.columns)).distinct()
    bare = F.regexp_replace("hit", "[+/_=-]+", "")
    ways = F.when(split & (F.char_length(bare) >= LEAST_SYMBOLS), F.array(F.lit(False), F.lit(True))).otherwise(F.array(F.lit(False)))
    return every.select("*", F.explode(ways).alias("bare"))


def _upper_tail(z: Column) -> Column:
    """Chance of a normal value above z, by a logistic curve."""
    return 1 / (1 + F.exp(F.least(F.lit(600.0), 1.5976 * z + 0.07056 * z * z * z)))


def name_letters() -> list[tuple[float, float, float]]:
    """(score, mean, variance) by state and letter, then a row of zeros.

    States: a word starts, after a vowel, after a consonant. The score of a letter is the log of
    its chance at random over its chance in names; mean and variance are those of the state in names.
    """
    out, all_letters = [], sum(LETTERS.values())
    share = sum(LETTERS[c] for c in VOWELS) / all_letters
    for vowel in NAME_VOWEL:
        fits = [f / all_letters * (vowel / share if c in VOWELS else (1 - vowel) / (1 - share)) for c, f in LETTERS.items()]
        chance = [(1 - NAME_ODD) * f + NAME_ODD / 26 for f in fits]
        score = [-math.log(26 * c) for c in chance]
        mean = sum(c * x for c, x in zip(chance, score))
        variance = sum(c * (x - mean) ** 2 for c, x in zip(chance, score))
        out += [(x, mean, variance) for x in score]
    return out + [(0.0, 0.0, 0.0)]


def name_steps() -> dict[str, tuple[float, ...]]:
    """By encoding: score of a neighbour that goes on and of one that starts anew, their mean and variance in names.

    Then what a letter adds by lying in the alphabet, over its mean in names, and the variance: zero unless letters are missing there.
    """
    out = {}
    for encoding, _, order in ENCODINGS:
        upper, lower, digit = (len(set(order) & set(c)) for c in (UPPER, LOWER, DIGITS))
        size = upper + lower + digit
        anew = 1 - (upper * (upper + lower) + lower * lower + digit * digit) / size / size
        on, start = math.log((1 - anew) / (1 - NAME_STEP)), math.log(anew / NAME_STEP)
        mean = NAME_STEP * start + (1 - NAME_STEP) * on
        held = sum(f for c, f in LETTERS.items() if c in order.lower()) / sum(LETTERS.values())
        inside = (-(1 - held) * math.log(held), held * (1 - held) * math.log(held) ** 2)
        out[encoding] = (on, start, mean, NAME_STEP * (1 - NAME_STEP) * (start - on) ** 2, *inside)
    return out


def like_names(sym: Column, encoding: Column) -> Column:
    """Chance that a name is as unlike names as the symbols, separators included; rows carry `plain`, their places in ALPHABET."""
    doubles = lambda a: F.array(*[F.lit(float(x)) for x in a])
    ints = lambda a: F.array(*[F.lit(x) for x in a])
    symbols = " " + ALPHABET  # places count from 1; 0 stands before the first symbol
    kinds = ints([3 if not c.isalnum() else 2 if c.isdigit() else 1 if c.islower() else 0 for c in symbols])
    places = ints([list(LETTERS).index(c.lower()) if c.isalpha() else -1 for c in symbols])
    states = ints([0 if not c.isalpha() else 1 if c.lower() in VOWELS else 2 for c in symbols])
    letters, none = name_letters(), len(LETTERS) * len(NAME_VOWEL)

    def code(a: Column, b: Column) -> Column:
        """What a symbol b after a is: 4 times the letter in its state, plus 1 if it goes on and 2 if it starts anew."""
        ka, kb = F.get(kinds, a), F.get(kinds, b)
        on = (ka == kb) | ((ka == 0) & (kb == 1))
        letter = F.when(kb <= 1, F.when(on, F.get(states, a)).otherwise(0) * len(LETTERS) + F.get(places, b)).otherwise(none)
        return letter * 4 + F.when((ka == 3) | (kb == 3), 0).when(on, 1).otherwise(2)

    codes = F.transform(sym, lambda b, i: code(F.when(i == 0, 0).otherwise(F.get(sym, i - 1)), b))
    steps = name_steps()
    of = lambda k: F.coalesce(*[F.when(encoding == e, F.lit(v[k])) for e, v in steps.items()])

    def chance(codes: Column) -> Column:
        count = lambda k: F.size(F.filter(codes, lambda c: c % 4 == k)).cast("double")
        letter = lambda k: doubles(row[k] for row in letters)
        total = lambda of_letter: F.aggregate(codes, F.lit(0.0), lambda s, c: s + F.get(of_letter, F.shiftright(c, 2)))
        n = F.size(F.filter(codes, lambda c: F.shiftright(c, 2) < none)).cast("double")
        off = total(letter(0)) - total(letter(1)) + count(1) * (of(0) - of(2)) + count(2) * (of(1) - of(2)) + n * of(4)
        spread = total(letter(2)) + (count(1) + count(2)) * of(3) + n * of(5)
        return F.when(spread <= 0, F.lit(1.0)).otherwise(_upper_tail(F.greatest(F.lit(-30.0), off / F.sqrt(F.greatest(spread, F.lit(1e-9))))))

    return let(codes, chance)


def battery(runs: DataFrame) -> DataFrame:
    """Adds encoding, n, p_random and p_name to rows with the columns hit and bare."""
    whole = F.translate(F.regexp_replace("hit", "=+$", ""), "-_", "+/")
    symbols = F.when(F.col("bare"), F.regexp_replace("hit", "[+/_=-]+", "")).otherwise(whole)
    encoding = F.coalesce(*[F.when(F.rlike("sym", F.lit(p)), F.lit(k)) for k, p, _ in ENCODINGS])
    coded = (
        runs.withColumn("whole", whole)
        .withColumn("sym", symbols)
        .withColumn("encoding", encoding)
        .withColumn("order", F.coalesce(*[F.when(F.col("encoding") == k, F.lit(o)) for k, _, o in ENCODINGS]))
        .withColumn("low", F.when(F.col("encoding") == "hex", F.lower("sym")).otherwise(F.col("sym")))
        .withColumn("x", F.expr("transform(split(low, '(?!^)(?!$)'), c -> locate(c, `order`))"))
        .withColumn("size", F.char_length("order").cast("double"))
        .withColumn("n", F.size("x").cast("double"))
    )
    total = lambda a: F.aggregate(a, F.lit(0.0), lambda s, v: s + v)
    squares = lambda x: total(
        F.transform(F.array_distinct(x), lambda d: F.pow(F.size(F.filter(x, lambda v: v == d)).cast("double"), F.lit(2.0)))
    )
    pairs = lambda x, f: total(F.transform(F.sequence(F.lit(1), F.size(x) - 1), lambda i: f(F.get(x, i - 1), F.get(x, i))))
    high = F.col("size") / 2
    plain = F.expr("transform(split(whole, '(?!^)(?!$)'), c -> locate(c, '%s'))" % ALPHABET)
    told = (
        coded.withColumn("squares", let(F.col("x"), squares))
        .withColumn("above", F.size(F.filter("x", lambda v: v > high)).cast("double"))
        .withColumn("turns", pairs(F.col("x"), lambda a, b: F.when((a > high) != (b > high), 1.0).otherwise(0.0)))
        .withColumn("mean", total(F.col("x")) / F.col("n"))
        .withColumn("spread", total(F.transform("x", lambda v: F.pow(v - F.col("mean"), F.lit(2.0)))))
        .withColumn("serial", pairs(F.col("x"), lambda a, b: (a - F.col("mean")) * (b - F.col("mean"))))
        .withColumn("plain", plain)
    )
    n, size, below = F.col("n"), F.col("size"), F.col("n") - F.col("above")
    chi = (size / n * F.col("squares") - n - (size - 1)) / F.sqrt(2 * (size - 1))
    mean_runs = 2 * F.col("above") * below / n + 1
    var_runs = (mean_runs - 1) * (mean_runs - 2) / (n - 1)
    runs_z = F.when(var_runs <= 0, F.lit(8.0)).otherwise(F.abs((F.col("turns") + 1 - mean_runs) / F.sqrt(F.greatest(var_runs, F.lit(1e-9)))))
    serial_z = F.when(F.col("spread") <= 0, F.lit(8.0)).otherwise(F.abs(F.try_divide(F.col("serial"), F.col("spread"))) * F.sqrt(n))
    logs = [F.log(F.greatest(F.lit(1e-12), p)) for p in (_upper_tail(chi), 2 * _upper_tail(runs_z), 2 * _upper_tail(serial_z))]
    half = -sum(logs[1:], logs[0])  # half of Fisher's statistic, with 6 degrees of freedom
    p_random = F.least(F.lit(1.0), F.exp(-half) * (1 + half + half * half / 2))
    return told.select(
        *runs.columns, "encoding", F.col("n").cast("long").alias("n"), p_random.alias("p_random"),
        like_names(F.col("plain"), F.col("encoding")).alias("p_name"),
    )


def _bin(p: Column) -> Column:
    return F.least(F.lit(BINS), F.floor(-10 * F.log10(F.greatest(F.lit(1e-300), F.least(F.lit(1.0), p))))).cast("int")


def _limits(runs: DataFrame, name: str, level: float) -> DataFrame:
    """(_class, name): the least bin that false-discovery control rejects, by class; at most one row a class."""
    counts = runs.groupBy("_class", F.col(name).alias("_bin")).agg(F.count(F.lit(1)).alias("c"))  # at most classes x bins rows
    smaller = Window.partitionBy("_class").orderBy(F.col("_bin").desc())
    every = Window.partitionBy("_class")
    ranked = counts.withColumn("rank", F.sum("c").over(smaller)).withColumn("all", F.sum("c").over(every))
    most = F.pow(F.lit(10.0), -F.col("_bin") / 10.0)  # the largest p-value of the bin
    return ranked.where(most <= level * F.col("rank") / F.col("all")).groupBy("_class").agg(F.min("_bin").alias(name))


def discoveries(tested: DataFrame) -> DataFrame:
    """The parts that stay random and are no names, with false discoveries of both held within length classes, each run once."""
    run = ["doc_id", "text_hash", "run"]
    rows = tested.withColumn("_class", F.least(F.floor(F.log2("run_size")), F.lit(LONGEST_CLASS)).cast("int"))
    spans = F.sum(F.when(F.col("bare"), 0).otherwise(1)).over(Window.partitionBy(*run))  # every span has one row that is not bare
    rows = rows.withColumn("_odd", _bin(F.col("p_random"))).withColumn("_far", _bin(F.col("p_name") * spans))
    rows = stage(rows)
    runs = rows.groupBy(*run, "_class").agg(F.min("_odd").alias("_odd_limit"), F.max("_far").alias("_far_limit"))
    runs = stage(runs.select("_class", "_odd_limit", "_far_limit"))
    told = rows.join(F.broadcast(_limits(runs, "_far_limit", FALSE_DISCOVERIES)), "_class").where(F.col("_far") >= F.col("_far_limit"))
    told = told.join(F.broadcast(_limits(runs, "_odd_limit", FALSE_DISMISSALS)), "_class", "left")
    return told.where(F.col("_odd_limit").isNull() | (F.col("_odd") < F.col("_odd_limit"))).select(*tested.columns)


def all_spans(texts: DataFrame) -> DataFrame:
    """Base spans, and those random runs that no base span touches and no longer one holds."""
    found = stage(matches(texts))
    base = found.where("kind <> 'random'").drop("hit")
    extra = discoveries(battery(with_parts(found.where("kind = 'random'")))).select(*base.columns).distinct()
    both = base.unionByName(extra)
    doc = Window.partitionBy("doc_id", "text_hash").orderBy("start", "no")
    is_base = F.col("kind") != "random"
    reach = F.max(F.when(is_base, F.col("end"))).over(doc.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    begin = F.min(F.when(is_base, F.col("start"))).over(doc.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    touched = F.coalesce(reach > F.col("start"), F.lit(False)) | F.coalesce(begin < F.col("end"), F.lit(False))
    free = both.withColumn("_touched", touched).where(is_base | ~F.col("_touched")).drop("_touched")
    longest = Window.partitionBy("doc_id", "text_hash").orderBy("start", F.col("end").desc(), "no")
    held = F.max(F.when(~is_base, F.col("end"))).over(longest.rowsBetween(Window.unboundedPreceding, -1)) >= F.col("end")
    return free.withColumn("_held", F.coalesce(held, F.lit(False))).where(is_base | ~F.col("_held")).drop("_held")


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of docs: n_assign, n_access, n_hex, base_sha256, spans."""
    texts = text_of(docs, id_col, text_col)
    keys = texts.select("doc_id", F.xxhash64("text").alias("text_hash"))
    shown = F.concat_ws(":", "kind", F.col("start").cast("string"), F.col("end").cast("string"))
    listed = F.struct("start", "no", shown.alias("shown"))
    joined = lambda a: F.array_join(F.transform(F.array_sort(a), lambda s: s["shown"]), ",")
    per_doc = (
        all_spans(texts)
        .groupBy("doc_id", "text_hash")
        .agg(
            *[F.count_if(F.col("kind") == k).cast("long").alias(f"n_{k}") for k in ("assign", "access", "hex")],
            F.sha2(joined(F.collect_list(F.when(F.col("kind") != "random", listed))), 256).alias("base_sha256"),
            joined(F.collect_list(listed)).alias("spans"),
        )
        .withColumnsRenamed({"doc_id": "_id", "text_hash": "_hash"})
    )
    out = keys.join(per_doc, same(keys, per_doc, [("doc_id", "_id"), ("text_hash", "_hash")]), "left")
    return out.select(
        "doc_id",
        *[F.coalesce(f"n_{k}", F.lit(0).cast("long")).alias(f"n_{k}") for k in ("assign", "access", "hex")],
        F.coalesce("base_sha256", F.sha2(F.lit(""), 256)).alias("base_sha256"),
        F.coalesce("spans", F.lit("")).alias("spans"),
    )

"""Benchmark decontamination by templates: questions are found again when numbers, names or units change.

DataFrame and SQL functions only. A text becomes three aligned arrays of tokens: its words in lower case
with numbers and units replaced by typed placeholders, and the same with names replaced as well, once
capitalised words that do not open a sentence and once all capitalised words; the first finds copies that
lost their capitals, the others copies with other names. Scripts without capitals have no names, and a
letter of a script without spaces is a token. Windows of tokens are hashed and hash-joined with the windows of the benchmark.
Windows of a document and an item that lie on one diagonal are then aligned token by token: the values
behind placeholders must map one to one (the same number in the item is always the same number in the
document, and the other way round). A window with a pair of values that another pair contradicts as often
or more often does not count, unless its tokens are the same in both.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from maskloom.functions.sizing import broadcast_if_small
from maskloom.llm.common import need, small_side, text_key
from maskloom.session import materialize

#: Words that name units.
UNITS = (
    "km kilometer kilometers kilometre kilometres m meter meters metre metres cm centimeter centimeters mm "
    "mile miles ft foot feet inch inches yard yards kg kilogram kilograms g gram grams mg lb lbs pound pounds "
    "oz ounce ounces ton tons liter liters litre litres ml gallon gallons second seconds minute minutes hour "
    "hours day days week weeks month months year years dollar dollars cent cents euro euros percent degree degrees"
).split()
NUMBER, UNIT, NAME = "<number>", "<unit>", "<name>"
#: A number or word, with the end of the sentence before it where there is one.
LETTERS = r"[\p{L}\p{M}]++"
TOKEN = r"(?:[.!?\n][^\p{L}\p{N}]*+)?(?:[0-9]++(?:[.,][0-9]++)*+|[\p{L}\p{M}]++)"
#: Scripts without spaces (Thai, Lao, Burmese, Khmer, Japanese, Chinese): one letter is a token.
RANGES = (r"\x{e00}-\x{eff}\x{1000}-\x{109f}\x{1780}-\x{17ff}\x{3040}-\x{30ff}\x{3400}-\x{4dbf}\x{4e00}-\x{9fff}"
          r"\x{f900}-\x{faff}\x{20000}-\x{3ffff}")


SPACELESS = rf"[{RANGES}]".replace("\\", "\\\\")
EITHER = rf"[{RANGES}&&[\p{{L}}]]\p{{M}}*+|[\p{{L}}\p{{M}}&&[^{RANGES}]]++".replace("\\", "\\\\")
LETTERS = LETTERS.replace("\\", "\\\\")


def templates(texts: DataFrame, *keys: str, values: bool = False) -> DataFrame:
    """``plain``, ``typed`` and ``opened`` (templates) and with ``values`` also ``v`` (tokens), aligned, of column ``t``."""
    units = ", ".join(f"'{u}'" for u in UNITS)
    token = TOKEN.replace("\\", "\\\\")
    # a token that opens a sentence still has the end of the sentence before it
    raw = texts.select(*keys, F.expr(
        f"CASE WHEN octet_length(t) > length(t) AND t RLIKE '{SPACELESS}' "
        f"THEN regexp_extract_all(concat('\\n', t), '{token.replace(LETTERS, EITHER)}', 0) "
        f"ELSE regexp_extract_all(concat('\\n', coalesce(t, '')), '{token}', 0) END").alias("x"))
    strip = "regexp_replace(w, '^[^\\\\p{L}0-9]+', '')"
    word = raw.select(*keys, "x", F.expr(
        f"transform(x, w -> CASE WHEN w < '0' THEN {strip} WHEN w >= '?' AND w < 'A' THEN {strip} ELSE w END)").alias("o"))
    lower = word.select(*keys, "x", "o", F.expr("transform(o, w -> lower(w))").alias("v"))
    plain = lower.select(*keys, "x", "o", "v", F.expr(
        f"transform(v, w -> CASE WHEN w < ':' THEN '{NUMBER}' WHEN w IN ({units}) THEN '{UNIT}' ELSE w END)"
    ).alias("plain"))
    # upper case of any script, in the first of several letters
    capital = (f"p NOT IN ('{NUMBER}', '{UNIT}') AND o[i] <> v[i] AND substr(o[i], 1, 1) <> substr(v[i], 1, 1) "
               "AND length(o[i]) > 1")
    opened = plain.select(*keys, "x", "o", "v", "plain", F.expr(
        f"CASE WHEN o = v THEN plain ELSE transform(plain, (p, i) -> CASE WHEN {capital} THEN '{NAME}' ELSE p END) END"
    ).alias("opened"))
    return opened.select(*keys, *["v"] * values, "plain", F.expr(
        f"CASE WHEN x = o THEN opened ELSE transform(opened, (p, i) -> CASE WHEN x[i] <> o[i] THEN plain[i] ELSE p END) END"
    ).alias("typed"), "opened")


def windows(rows: DataFrame, width: int, stride: int, *keys: str) -> DataFrame:
    """Hashes of every ``stride``-th window with its place; those of the other templates where they differ."""
    def code(column: str) -> str:
        # tokens one by one: a slice would copy the window first
        return f"xxhash64({', '.join(f'{column}[i + {j}]' for j in range(width))})"

    def every(*columns: str) -> str:
        names = zip("pto", columns)
        return (f"transform(sequence(0, size(plain) - {width}, {stride}), "
                f"i -> struct(i AS at, {', '.join(f'{code(c)} AS {n}' for n, c in names)}))")

    # the same window has the same hash in all templates; without names all are the same
    all_three = rows.select(*keys, F.explode(F.expr(
        f"CASE WHEN size(plain) < {width} THEN NULL WHEN array_contains(opened, '{NAME}') THEN {every('plain', 'typed', 'opened')} "
        f"ELSE transform({every('plain')}, w -> struct(w.at AS at, w.p AS p, w.p AS t, w.p AS o)) END")).alias("w"))
    return all_three.select(*keys, F.col("w.at").alias("at"), F.explode(F.expr(
        "CASE WHEN w.p = w.t AND w.t = w.o THEN array(w.p) WHEN w.p = w.t THEN array(w.p, w.o) "
        "WHEN w.t = w.o THEN array(w.p, w.t) ELSE array(w.p, w.t, w.o) END")).alias("h"))


def find_leaks(
    docs: DataFrame, benchmark: DataFrame, *, width: int = 7, stride: int = 3, least: float = 0.5, run: int = 16,
    literals: int = 3,
) -> DataFrame:
    """Documents that hold a benchmark item, as it is or with other numbers, names or units.

    ``docs`` needs ``doc_id`` and ``text``, ``benchmark`` needs ``item_id`` and ``text``. One row per
    document and item found: doc_id, th (hash of the text), item_id, n_windows (windows of ``width`` tokens of
    the item found on consistent diagonals), coverage (their share of the item's windows, at least
    ``least``, or less where ``run`` tokens of the item stand verbatim in the document), n_slots (placeholder positions in matched windows) and n_changed (those whose values differ).

    Placeholders alone are no evidence: a window that is not the same in both counts only if ``literals`` of its
    tokens are matched as they are. Hash-joined are all windows of ``width - stride + 1`` tokens of the items with every ``stride``-th one
    of the documents, of which each window of ``width`` tokens holds one. Items with fewer than ``width``
    tokens are one window and found where all their tokens stand in a row as they are. Null texts have no tokens; null ids take part as
    such; repeated documents and items are reported once each; other columns are left out.
    """
    seed = width - stride + 1
    if seed < 1 or stride < 1:
        raise ValueError("stride must be between 1 and width")
    items = templates(
        need(benchmark, "item_id", "text").distinct().select(
            "item_id", F.monotonically_increasing_id().alias("k"), F.col("text").alias("t")),
        "item_id", "k", values=True)
    items = materialize(items.withColumn("total", F.size("plain") - (width - 1)))
    short = items.where((F.col("total") < 1) & (F.size("plain") > 0)).select("item_id", F.col("v").alias("iv"))
    items = items.where("total >= 1")
    asked = materialize(windows(items, seed, 1, "k").distinct().withColumnRenamed("at", "iat"))
    texts = need(docs, "doc_id", "text").select(
        F.col("doc_id").cast("long").alias("d"), text_key("text").alias("th"), F.col("text").alias("t"))
    own = windows(templates(texts, "d", "th"), seed, stride, "d", "th")
    hits = materialize(own.join(small_side(asked, 32), "h").groupBy(
        "d", "th", "k", (F.col("at") - F.col("iat")).alias("diagonal")).agg(F.countDistinct("at").alias("n")))
    # a share of the windows, or a verbatim run, needs at least so many seeds
    enough = hits.groupBy("d", "th", "k").agg(F.sum("n").alias("n"), F.max("n").alias("most")).join(
        small_side(items.select("k", "total"), 16), "k").where(
            (F.col("n") * stride >= least * F.col("total")) | (F.col("most") >= (run - seed + 1) // stride))
    enough = enough.select(F.col("d").alias("ed"), F.col("th").alias("eth"), F.col("k").alias("ek"))
    chosen = materialize(hits.join(
        enough, F.col("d").eqNullSafe(F.col("ed")) & (F.col("th") == F.col("eth")) & (F.col("k") == F.col("ek")),
        "left_semi"))
    names = chosen.select(F.col("d").alias("cd"), F.col("th").alias("cth")).distinct()
    picked = texts.join(small_side(names, 16), F.col("d").eqNullSafe(F.col("cd")) & (F.col("th") == F.col("cth")),
                        "left_semi").dropDuplicates(["d", "th"])
    values = templates(picked, "d", "th", values=True).select(
        F.col("d").alias("vd"), F.col("th").alias("vth"), F.col("v").alias("dv"), F.col("plain").alias("dplain"),
        F.col("typed").alias("dtyped"), F.col("opened").alias("dopened"))
    aligned = (
        chosen.join(values, F.col("d").eqNullSafe(F.col("vd")) & (F.col("th") == F.col("vth")))
        .join(broadcast_if_small(items), "k"))
    same = F.expr("transform(plain, (p, i) -> coalesce(p = get(dplain, i + diagonal) "
                  "OR typed[i] = get(dtyped, i + diagonal) OR opened[i] = get(dopened, i + diagonal), false))")
    exact = F.expr("transform(v, (w, i) -> coalesce(w = get(dv, i + diagonal), false))")
    kind = F.expr(f"""transform(plain, (p, i) ->
          CASE WHEN p = get(dplain, i + diagonal) AND p IN ('{NUMBER}', '{UNIT}') THEN p
               WHEN opened[i] = '{NAME}' AND (opened[i] = get(dopened, i + diagonal) OR p = get(dplain, i + diagonal))
               THEN '{NAME}' END)""")
    judged = aligned.select("d", "th", "k", "item_id", "total", "v", "dv", "diagonal", same.alias("m"),
                            exact.alias("e"), kind.alias("kind"))
    steps = {
        "verbatim": f"""exists(filter(sequence(0, size(e)), i -> i + {run} <= size(e)),
              i -> NOT array_contains(slice(e, i + 1, {run}), false))""",
        "w": f"transform(sequence(0, total - 1), i -> NOT array_contains(slice(m, i + 1, {width}), false))",
        # slots count where a matched window holds them
        "s": f"""transform(kind, (t, i) -> CASE WHEN t IS NOT NULL AND array_contains(
              slice(w, greatest(i - {width - 1}, 0) + 1, least(i, {width - 1}) + 1), true)
              THEN struct(t AS kind, v[i] AS a, get(dv, i + diagonal) AS b) END)""",
        "held": "filter(s, x -> x IS NOT NULL)",
        "pairs": "transform(array_distinct(held), p -> struct(p AS p, size(filter(held, q -> q = p)) AS n))",
        # pairs that another pair with one of their values equals or outnumbers
        "odd": """transform(filter(pairs, x -> exists(pairs, y -> y.p <> x.p AND y.p.kind = x.p.kind
              AND (y.p.a = x.p.a OR y.p.b = x.p.b) AND y.n >= x.n)), x -> x.p)""",
        "bad": "transform(s, x -> coalesce(array_contains(odd, x), false))",
        "n": f"""size(filter(sequence(0, total - 1), i -> w[i] AND (NOT array_contains(slice(e, i + 1, {width}), false)
              OR (NOT array_contains(slice(bad, i + 1, {width}), true)
                  AND size(filter(slice(kind, i + 1, {width}), t -> t IS NULL)) >= {literals}))))""",
    }
    for name, text in steps.items():
        if name in ("w", "s", "pairs", "bad", "n"):  # stored, or the optimiser puts it into the loops of the next
            judged = materialize(judged)
        judged = judged.withColumn(name, F.expr(text))
    found = materialize(judged).where("n > 0").groupBy("d", "th", "k", "item_id").agg(
        F.sum("n").alias("n_windows"), F.first("total").alias("total"), F.sum(F.size("held")).alias("n_slots"),
        F.sum(F.expr("size(filter(held, x -> x.a <> x.b))")).alias("n_changed"), F.max("verbatim").alias("verbatim"))
    found = found.select(
        F.col("d").alias("doc_id"), "th", "item_id", F.least("n_windows", "total").cast("long").alias("n_windows"),
        F.least(F.col("n_windows") / F.col("total"), F.lit(1.0)).alias("coverage"),
        F.col("n_slots").cast("long").alias("n_slots"), F.col("n_changed").cast("long").alias("n_changed"), "verbatim")
    found = found.where((F.col("coverage") >= least) | F.col("verbatim")).drop("verbatim")
    lengths = [r.n for r in short.select(F.size("iv").alias("n")).distinct().orderBy("n").collect()]
    if not lengths:
        return found
    pieces = ", ".join(
        f"CASE WHEN size(v) >= {n} THEN transform(sequence(0, size(v) - {n}), i -> slice(v, i + 1, {n})) ELSE array() END"
        for n in lengths)
    runs = templates(texts, "d", "th", values=True).select("d", "th", F.explode(F.expr(f"concat({pieces})")).alias("iv"))
    whole = runs.join(small_side(short, 512), "iv").select(
        F.col("d").alias("doc_id"), "th", "item_id", F.lit(1).cast("long").alias("n_windows"),
        F.lit(1.0).alias("coverage"), F.lit(0).cast("long").alias("n_slots"), F.lit(0).cast("long").alias("n_changed"))
    return found.unionByName(whole.distinct())


def without_leaks(docs: DataFrame, benchmark: DataFrame, **settings) -> DataFrame:
    """The rows of ``docs`` in which ``find_leaks`` finds no item."""
    found = materialize(find_leaks(docs, benchmark, **settings).select(
        F.col("doc_id").alias("__d"), F.col("th").alias("__th")).distinct())
    marked = docs.withColumns({"__id": F.col("doc_id").cast("long"), "__key": text_key("text")})
    return marked.join(
        small_side(found, 16), F.col("__id").eqNullSafe(F.col("__d")) & (F.col("__key") == F.col("__th")),
        "left_anti").select(*docs.columns)

"""Linking the spellings of names that people typed: prefix-filtered set-similarity join on q-grams of tokens, verified by soft weighted token similarity.

Every distinct name is parsed into tokens: of a person the family name, the given name (nicknames replaced) and further initials; of an organisation its own name,
its kind and its topic. Family tokens are joined by their q-grams: each token's grams are ordered from rare to frequent, and
only the first of them, enough that two tokens within the distance must share one, are joined; candidates are verified by edit distance. Within a
group of similar family tokens the other tokens are compared softly and weighted by rarity: what few names contain counts more. Initials join the only
given name they fit, or the one that clearly dominates.

Cases: null, blank and letterless names are never linked; names that differ only in case, accents, spaces, titles, order or misread bytes are
linked; repeated rows count as mentions and give no repeated pairs; any length is parsed whole; people with only the family name in common stay
apart, as do organisations of different kind or topic.
"""

from __future__ import annotations

import html
import re
import unicodedata
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window as W

from sieveline.llm.components import components
from sieveline.runtime import discard, stored

#: Length of the grams, and how many rare ones two tokens must share to be compared.
Q, SHARED = 3, 3
#: Letters from which a transposition counts once also beside another edit.
LONG = 12
#: Least weighted similarity of two names whose family tokens are similar.
LEAST_SIMILARITY = 0.8
#: How many times as frequent a given name must be as the next that fits an initial.
DOMINANCE = 4

#: Usual short forms of given names.
NICKNAMES = {
    "abby": "abigail", "alex": "alexander", "sasha": "alexander", "tony": "anthony", "ben": "benjamin", "chris": "christopher", "kit": "christopher",
    "dan": "daniel", "danny": "daniel", "deb": "deborah", "debbie": "deborah", "dima": "dimitri", "mitya": "dimitri", "liz": "elizabeth", "beth": "elizabeth", "betty": "elizabeth", "fran": "francesca",
    "lupe": "guadalupe", "gus": "gustav", "jen": "jennifer", "jenny": "jennifer", "hans": "johannes", "kate": "katharine", "kathy": "katharine", "ken": "kenneth",
    "enzo": "lorenzo", "renzo": "lorenzo", "meg": "margaret", "maggie": "margaret", "peggy": "margaret", "mike": "michael", "mick": "michael", "nick": "nicholas", "seun": "oluwaseun", "pat": "patricia", "patty": "patricia", "trish": "patricia", "tricia": "patricia",
    "ravi": "ravindra", "becky": "rebecca", "becca": "rebecca", "bob": "robert", "rob": "robert", "bert": "robert", "sam": "samuel", "sue": "susanna", "susie": "susanna", "suzy": "susanna", "suzie": "susanna", "ted": "theodore", "theo": "theodore",
    "vicky": "victoria", "vicki": "victoria", "tori": "victoria", "bill": "william", "will": "william", "billy": "william", "zhenya": "yevgenia",
}
#: Kinds of organisation and how they are shortened.
KINDS = {
    "laboratory": "lab", "lab": "lab", "labs": "lab", "laboratories": "lab", "labor": "lab", "institute": "inst", "institut": "inst", "inst": "inst", "insti": "inst", "centre": "cent", "center": "cent", "ctr": "cent", "cent": "cent", "cen": "cent", "centr": "cent",
    "consortium": "cons", "cons": "cons", "consort": "cons", "conso": "cons", "collaboration": "coll", "collab": "coll", "coll": "coll", "colla": "coll", "group": "group", "grp": "group", "team": "group", "university": "univ", "univ": "univ", "department": "dept", "dept": "dept", "school": "school", "network": "netw", "society": "soc", "foundation": "found",
}
LONG_KINDS = ["laboratory", "institute", "centre", "consortium", "collaboration", "university", "department"]
TITLES = {"dr", "prof", "professor", "mr", "mrs", "ms", "miss", "sir", "mx", "phd", "md", "jr", "sr", "eng"}
JOINING = {"for", "of", "the", "and", "in", "on"}


def repaired(text: str) -> str:
    """Undoes UTF-8 that was read as Latin."""
    if re.search(r"[ÃÂâ]", text):
        for code in ("cp1252", "latin-1"):
            try:
                return text.encode(code).decode("utf-8")
            except (UnicodeEncodeError, UnicodeDecodeError):
                pass
    return text


def plain(text: str) -> str:
    text = unicodedata.normalize("NFKD", text)
    return "".join(c for c in text if not unicodedata.combining(c) and unicodedata.category(c) != "Cf")


def near(a: str, b: str, most: int) -> bool:
    """Optimal string alignment distance of at most most."""
    if abs(len(a) - len(b)) > most:
        return False
    before, row = [], list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, before, row = before, row, [i]
        for j, y in enumerate(b, 1):
            d = min(before[j] + 1, row[j - 1] + 1, before[j - 1] + (x != y))
            if last and j > 1 and x == b[j - 2] and a[i - 2] == y:
                d = min(d, last[j - 2] + 1)
            row.append(d)
    return row[-1] <= most


def kind_of(token: str) -> str | None:
    if token in KINDS:
        return KINDS[token]
    if len(token) >= 5:
        for k in LONG_KINDS:
            if near(token, k, 2):
                return KINDS[k]
    return None


def parse(name: str) -> tuple[str, str, str, str] | None:
    """(person or organisation's kind, family or own name, given name or topic, initials); None without letters."""
    text = plain(repaired(html.unescape(name))).replace("ß", "ss")
    tokens = re.findall(r"[^\W\d_]+(?:['’-][^\W\d_]+)*|[,()]", text)
    words = [t for t in tokens if t not in ",()"]
    if not words:
        return None
    low = [w.lower() for w in words]
    kinds = [(i, k) for i, w in enumerate(low) if (k := kind_of(w))]
    if kinds and len(low) >= 3 and low[0] not in TITLES:
        i, kind = kinds[0]
        before = [w for w in low[:i] if w not in JOINING]
        after = [w for w in low[i + 1 :] if w not in JOINING]
        if before:
            own, topic = before[0], before[1:] + after
        elif "," in tokens and after:
            own, topic = after[-1], after[:-1]
        else:
            own, topic = (max(after, key=len), after) if after else (low[i], [])
        return kind, own, " ".join(w[:4] for w in topic), ""
    # DR at the end are initials.
    kept = [(w, t) for i, (w, t) in enumerate(zip(low, words)) if w not in TITLES or i and t.isupper() and len(t) == 2] or list(zip(low, words))
    words = [t for _, t in kept]
    comma = tokens.index(",") if "," in tokens else -1
    head = [t for t in tokens[:comma] if t in words] if comma > 0 else []
    if head and len(head) < len(words):
        family, rest = head[-1], words[len(head) :]
    else:
        upper = [len(t) >= 4 and t.isupper() for t in words]
        initials = [len(t) <= 3 and t.isupper() for t in words]
        if len(words) == 1:
            family, rest = words[0], []
        elif any(upper) and not all(u or i for u, i in zip(upper, initials)):
            at = upper.index(True)
            family, rest = words[at], words[:at] + words[at + 1 :]
        elif initials[-1] and not initials[0] and len(words[0]) > 3:
            family, rest = words[0], words[1:]
        else:
            family, rest = words[-1], words[:-1]
    given, initials_ = "", ""
    for t in rest:
        if len(t) <= 3 and t.isupper() and not (len(t) == 3 and family.isupper()):
            initials_ += t.lower()
        elif len(t) == 1:
            initials_ += t.lower()
        elif not given:
            given = t.lower()
        else:
            initials_ += t[0].lower()
    return "person", family.lower(), NICKNAMES.get(given, given), initials_


def parsed(names: DataFrame, name: str) -> DataFrame:
    """Columns name, kind, own, other, initials of the distinct names that have letters."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(0).to_pylist()
            out = [parse(x) or (None,) * 4 for x in texts]
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array([o[i] for o in out], pa.string()) for i in range(4)), batch.column(1)], names=["name", "kind", "own", "other", "initials", "mentions"])

    counted = names.where(F.length(F.trim(name)) > 0).groupBy(F.col(name).alias("name")).agg(F.count("*").alias("mentions"))
    return counted.mapInArrow(run, "name string, kind string, own string, other string, initials string, mentions bigint").where("own is not null")


def edits(a: Column, b: Column) -> Column:
    """Edit distance; two letters that changed places count once."""
    d = F.levenshtein(a, b)
    letters = lambda x: F.array_sort(F.split(x, ""))
    return F.when((d == 2) & (letters(a) == letters(b)), 1).otherwise(d)


def most_edits(n: Column) -> Column:
    """Tokens under five letters must be equal: most that are one edit apart are names of their own (Chen, Cheng, Chan; Lin, Liu)."""
    return F.when(n < 5, 0).when(n < 7, 1).otherwise(2)


@F.pandas_udf(T.BooleanType())
def aligned(a: pd.Series, b: pd.Series) -> pd.Series:
    """Whether at most two edits apart, a transposition of neighbours being one; False where null."""
    return pd.Series([x is not None and near(x, y, 2) for x, y in zip(a, b)])


def similar_tokens(tokens: DataFrame, token: str = "own") -> DataFrame:
    """Pairs a < b (stored) of distinct tokens within the edit distance that their length allows, by a prefix-filtered join on q-grams.

    From LONG letters on a transposition of neighbours is one edit also beside others (up to Levenshtein distance 4). Three separate edits make
    another family: where no nearer spelling bridges them, both are names of their own.

    A token of n letters has at most n + Q - 1 padded grams, and an edit changes at most Q of them, a transposition Q + 1; so tokens within d edits share
    SHARED of their d * Q (long ones: d * (Q + 1)) + SHARED rarest grams, and the join is on combinations of so many grams of that prefix, which few tokens have in common.
    A gram that a token repeats is numbered, so that repeats count too. Tokens of one edit (under 7 letters) have too few grams for a change of
    places, which is two edits to Levenshtein; what has the same letters is joined by those.
    """
    n = F.length(token)
    padded = F.concat(F.lit("^" * (Q - 1)), F.col(token), F.lit("$" * (Q - 1)))
    plain_grams = F.transform(F.sequence(F.lit(1), n + Q - 1), lambda i: F.substring(padded, i, F.lit(Q)))
    grams = F.transform(plain_grams, lambda g, i: F.concat(g, F.size(F.filter(F.slice(plain_grams, 1, i + 1), lambda x: x == g)).cast("string")))
    one = stored(tokens.select(token).where(n >= 5).distinct().select(F.col(token).alias("token"), n.alias("n"), F.explode(grams).alias("gram")), "grams")
    often = one.groupBy("gram").agg(F.count("*").alias("df"))
    rarest = one.join(often, "gram").groupBy("token", "n").agg(F.array_sort(F.collect_list(F.struct("df", "gram"))).alias("g"))
    rarest = rarest.select("token", "n", F.array_sort(F.slice("g.gram", F.lit(1), most_edits(F.col("n")) * F.when(F.col("n") < LONG, Q).otherwise(Q + 1) + SHARED)).alias("g"))
    combined = F.expr("flatten(transform(sequence(0, size(g) - 3), i -> flatten(transform(sequence(i + 1, size(g) - 2), j -> transform(sequence(j + 1, size(g) - 1), k -> xxhash64(g[i], g[j], g[k]))))))")
    letters = F.when(F.col("n") < 7, F.array(F.xxhash64(F.array_sort(F.split("token", ""))))).otherwise(F.array().cast("array<bigint>"))
    keys = stored(rarest.select("token", "n", F.explode(F.concat(combined, letters)).alias("key")), "keys")
    a = keys.select("key", F.col("token").alias("a"), F.col("n").alias("na"))
    b = keys.select("key", F.col("token").alias("b"), F.col("n").alias("nb"))
    pairs = a.join(b, "key").where((F.col("a") < F.col("b")) & (F.abs(F.col("na") - F.col("nb")) <= most_edits(F.least("na", "nb"))))
    near_by = pairs.select("a", "b", F.least("na", "nb").alias("n")).distinct().withColumn("d", F.levenshtein("a", "b"))
    few = edits(F.col("a"), F.col("b")) <= most_edits(F.col("n"))
    near_by = near_by.where(few | ((F.col("n") >= LONG) & (F.col("d") <= 4)))
    asked = lambda c: F.when(F.col("d") > 2, F.col(c))
    found = stored(near_by.where((F.col("d") <= 2) | aligned(asked("a"), asked("b"))).select("a", "b"), "similar")
    discard(one), discard(keys)
    return found


def entities(mentions: DataFrame, name: str) -> DataFrame:
    """Columns name and entity of each distinct name that has letters."""
    names = stored(parsed(mentions.select(name), name), "names")
    tokens = names.select("own").distinct()
    pairs = similar_tokens(tokens)
    family = components(pairs.unionAll(tokens.select(F.col("own").alias("a"), F.col("own").alias("b"))), "a", "b", "own", "family")
    rows = names.join(family, "own")
    # Full given names and topics, as often as they are mentioned in the family.
    whole = rows.where("other <> ''").groupBy("family", "kind", "other").agg(F.sum("mentions").alias("n"))
    total = names.count()
    weight = lambda c: F.log1p(F.lit(float(total)) / F.greatest(c, F.lit(1)))
    rare_family = rows.groupBy("family").agg(F.count("*").alias("family_df"))
    rare_other = rows.where("other <> ''").groupBy("other").agg(F.count("*").alias("other_df"))
    weighted = stored(whole.join(rare_family, "family").join(rare_other, "other").select("family", "kind", "other", "n", weight(F.col("family_df")).alias("wf"), weight(F.col("other_df")).alias("wo")), "weighted")
    x = weighted.select("family", "kind", "other", "n", "wf", "wo")
    y = weighted.select("family", "kind", F.col("other").alias("other2"), F.col("n").alias("n2"), F.col("wo").alias("wo2"))
    both = x.join(y, ["family", "kind"])
    soft = 1 - edits(F.col("other"), F.col("other2")) / F.greatest(F.length("other"), F.length("other2"))
    wo = F.least("wo", "wo2")  # of the better known spelling: a misspelt name is rare only because it is misspelt
    similarity = (F.col("wf") + wo * soft) / (F.col("wf") + wo)
    fits = both.where((F.col("other") == F.col("other2")) | ((soft >= 0.6) & (similarity >= LEAST_SIMILARITY)))
    chosen = fits.groupBy("family", "kind", "other").agg(F.max_by("other2", F.struct("n2", "other2")).alias("to"))
    full = rows.where("other <> ''").join(chosen, ["family", "kind", "other"]).select("name", F.concat_ws("|", "kind", "family", "to").alias("entity"))
    # Initials: the only or clearly dominating given name of the family that begins so.
    known = whole.join(chosen, ["family", "kind", "other"]).where("kind = 'person'").groupBy("family", F.col("to").alias("given")).agg(F.sum("n").alias("n"))
    best = known.groupBy("family", F.substring("given", 1, 1).alias("first")).agg(F.max_by("given", F.struct("n", "given")).alias("given"), F.max("n").alias("top"), F.sum("n").alias("n"))
    short = rows.where("other = ''").withColumn("first", F.substring("initials", 1, 1)).join(best, ["family", "first"], "left")
    given = F.when((F.col("kind") == "person") & (F.col("n") - F.col("top") <= F.col("top") / DOMINANCE), F.col("given")).otherwise(F.concat(F.lit("."), "first"))
    return full.unionAll(short.select("name", F.concat_ws("|", "kind", "family", given).alias("entity")))


def linked_names(mentions: DataFrame, name: str) -> DataFrame:
    """Pairs name_a < name_b of different strings that name the same person or organisation."""
    each = stored(entities(mentions, name), "entities")
    a, b = each.select("entity", F.col("name").alias("name_a")), each.select("entity", F.col("name").alias("name_b"))
    return a.join(b, "entity").where("name_a < name_b").select("name_a", "name_b").distinct()

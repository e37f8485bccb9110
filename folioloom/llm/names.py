"""Linking the variant spellings of people and organisations.

Merge-and-rematch resolution. Every spelling is parsed into surname, given
name and initials. Each round, profiles emit blocking keys from all the
spellings and initials they hold so far; a block keeps only its least and
greatest full profile and its best supported one, so a weak form (initials,
nickname, abbreviation) links where exactly one full profile stands, and a
misspelt one links to the best supported name within one edit. Merged profiles
union their spellings and initials and enter blocking again, until a round
brings no merge. No block is expanded into pairs and none is collected.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..runtime import arrow_schema, cut

# English short forms and the given names they stand for.
NICKNAMES = """
abby:abigail amy:amelia andy:andrew art:arthur barb:barbara barbie:barbara becky:rebecca bella:isabella ben:benjamin benny:benjamin
bernie:bernard beth:elizabeth betsy:elizabeth betty:elizabeth bill:william billy:william bob:robert bobby:robert cathy:catherine,katherine
charlie:charles chris:christopher,christine chuck:charles cindy:cynthia connie:constance dan:daniel danny:daniel dave:david deb:deborah
debbie:deborah dick:richard don:donald donnie:donald dot:dorothy dottie:dorothy drew:andrew ed:edward eddie:edward ellie:eleanor eliza:elizabeth
fran:francesca,frances frank:francis fred:frederick freddy:frederick gabby:gabrielle gail:abigail gene:eugene george:georgina greg:gregory hal:harold
harry:harold,henry hettie:henrietta etta:henrietta izzy:isabella jack:john jackie:jacqueline jake:jacob jamie:james jeff:jeffrey jen:jennifer
jenny:jennifer jerry:gerald,jerome jess:jessica jim:james jimmy:james joe:joseph joey:joseph jon:jonathan josie:josephine jo:josephine judy:judith
kate:katherine kathy:katherine katie:katherine kay:katherine ken:kenneth kenny:kenneth kit:katherine,christopher larry:lawrence len:leonard lenny:leonard
leo:leonard lin:linda lindy:linda liz:elizabeth lizzie:elizabeth lou:louis,louise maddy:madeleine maggie:margaret meg:margaret peggy:margaret
marge:margaret matt:matthew max:maxwell mick:michael mike:michael mickey:michael nan:nancy nate:nathaniel nat:nathaniel ned:edward nell:eleanor
nellie:eleanor nick:nicholas nicky:nicholas pam:pamela pat:patricia,patrick patty:patricia tricia:patricia trish:patricia penny:penelope pete:peter
phil:philip ray:raymond rich:richard rick:richard rob:robert robbie:robert ron:ronald ronnie:ronald rose:rosemary rosie:rosemary sam:samuel
sammy:samuel sandy:sandra steve:stephen sue:susan susie:susan ted:theodore,edward teddy:theodore terry:teresa tess:teresa tessa:teresa theo:theodore
tim:timothy timmy:timothy tom:thomas tommy:thomas tony:anthony val:valerie vic:victoria vicky:victoria tori:victoria vince:vincent walt:walter
will:william winnie:winifred win:winifred zach:zachary zack:zachary
"""
_NICK = {k: v.split(",") for k, v in (x.split(":") for x in NICKNAMES.split())}
# Words that make a name an organisation's, and words its name may leave out.
ORG_WORDS = {"lab", "labs", "laboratory", "laboratories", "institute", "centre", "center", "department", "dept", "university", "college", "unit", "group", "society", "clinic", "school", "association"}
ORG_SMALL = {"the", "of", "for", "and", "in", "at", "on"}
ORG_SAME = {"labs": "lab", "laboratory": "lab", "laboratories": "lab", "centre": "center", "dept": "department"}
_LETTERS = str.maketrans({"ł": "l", "ø": "o", "đ": "d", "ß": "ss", "æ": "ae", "œ": "oe", "ð": "d", "þ": "th", "ı": "i"})
_QUOTED = re.compile(r"[\"“”«»„]\s*([^\"“”«»„]*?)\s*[\"“”«»„]")
_SUFFIX = {"jr", "sr", "ii", "iii", "phd", "md", "dr", "prof"}


def fold(s: str) -> str:
    s = unicodedata.normalize("NFKD", s.casefold()).translate(_LETTERS)
    return "".join(c for c in s if not unicodedata.combining(c))


def _initials(token: str) -> str:
    """The letters of a token made of initials, else ''."""
    bare = token.replace("-", "")
    letters = [c for c in bare if c.isalpha()]
    if not letters or any(not (c.isalpha() or c == ".") for c in bare):
        return ""
    if "." in bare and all(len(p) <= 1 for p in bare.split(".")):
        return fold("".join(letters))
    if len(letters) <= 2 and bare == "".join(letters) and (len(letters) == 1 or bare.isupper()):
        return fold("".join(letters))
    return ""


def parse(text: str | None) -> dict:
    """Kind and parts of one spelling. ``flip`` tells that two bare words may stand in either order."""
    out = {"kind": "none", "sur": "", "given": "", "gtype": "", "ini": "", "mid": "", "flip": False}
    text = " ".join(unicodedata.normalize("NFKC", text or "").split())
    nick = [fold(m) for m in _QUOTED.findall(text)]
    text = " ".join(_QUOTED.sub(" ", text).split()) if not (text[:1] in "\"“" and text[-1:] in "\"”") else text[1:-1]
    if not any(c.isalpha() for c in text):
        return out
    words = re.findall(r"[^\W\d_]+", fold(re.sub(r"\([^)]*\)", " ", text).replace("&", " and ")))
    if any(w in ORG_WORDS for w in words) and len(words) > 1:
        kept = sorted(ORG_SAME.get(w, w) for w in words if w not in ORG_SMALL)
        return out | {"kind": "org", "sur": " ".join(kept), "gtype": "full"}
    left, comma, right = text.partition(",")
    if comma and right.strip():
        sur, rest = left.split(), right.replace(",", " ").split()
    else:
        toks = left.split()
        marks = [_initials(t) for t in toks]
        if len(toks) > 1 and marks[-1] and not marks[0]:
            sur, rest = toks[:-1], toks[-1:]
            tail = [i for i in range(len(toks)) if marks[i]]
            if tail and tail[0] >= 1:
                sur, rest = toks[: tail[0]], toks[tail[0] :]
        else:
            sur, rest = toks[-1:], toks[:-1]
            # Particles belong to the surname.
            while len(rest) > 1 and rest[-1].islower() and len(rest[-1]) <= 3 and not text.islower():
                sur.insert(0, rest.pop())
            out["flip"] = len(toks) == 2 and not any(marks)
    rest = [t for t in rest if fold(t).strip(".") not in _SUFFIX] or rest
    out |= {"kind": "person", "sur": fold(" ".join(sur)).replace(".", "").strip()}
    given, initials = "", ""
    for t in rest:
        mark = _initials(t)
        if mark:
            initials += mark
        elif not given:
            given = t
        else:
            initials += fold(t)[:1]
    if given:
        g = fold(given)
        short = g.endswith(".") and len(g) > 2
        g = g.strip(".,'")
        first = _initials(rest[0]) if rest else ""
        out |= {"given": g, "gtype": "abbr" if short else "nick" if g in _NICK else "full", "ini": g[:1], "mid": initials[:1] if not first else ""}
        if first:
            out |= {"given": g, "mid": first[:1], "gtype": out["gtype"]}
    elif initials:
        out |= {"gtype": "init", "ini": initials[0], "mid": initials[1:2]}
    else:
        out |= {"gtype": "bare"}
    if nick and out["gtype"] == "bare":
        out |= {"given": nick[0], "gtype": "nick" if nick[0] in _NICK else "full", "ini": nick[0][:1]}
    return out


_PARSED = T.StructType(
    [T.StructField("form_id", T.LongType())] + [T.StructField(c, T.StringType()) for c in ("kind", "sur", "given", "gtype", "ini", "mid")] + [T.StructField("flip", T.BooleanType()), T.StructField("canon", T.ArrayType(T.StringType()))]
)


def parse_forms(forms: DataFrame, key: str, text: str) -> DataFrame:
    schema = arrow_schema(_PARSED)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for i, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                p = parse(t)
                rows.append({"form_id": i} | p | {"canon": _NICK.get(p["given"], [])})
            yield pa.RecordBatch.from_pylist(rows, schema=schema)

    return forms.select(F.col(key).cast("long").alias("form_id"), text).filter("form_id is not null").mapInArrow(work, _PARSED).filter("kind <> 'none'")


def orient(parsed: DataFrame) -> DataFrame:
    """Puts 'Surname Given' right, by how often each word is a given name or a surname where that is certain."""
    sure = parsed.filter("kind = 'person' and not flip and gtype in ('full', 'nick')")
    roles = sure.select(F.explode(F.array(F.struct(F.col("given").alias("w"), F.lit(1).alias("g")), F.struct(F.col("sur").alias("w"), F.lit(-1).alias("g")))).alias("r")).groupBy("r.w").agg(F.sum("r.g").alias("g"))
    unsure = parsed.filter("flip").join(roles.select(F.col("w").alias("given"), F.col("g").alias("gg")), "given", "left").join(roles.select(F.col("w").alias("sur"), F.col("g").alias("sg")), "sur", "left")
    known = F.size("canon") > 0
    turn = (F.coalesce("sg", F.lit(0)) > 0) & (F.coalesce("gg", F.lit(0)) <= 0) & ~known | (F.coalesce("sg", F.lit(0)) == 0) & (F.coalesce("gg", F.lit(0)) < 0)
    swapped = unsure.withColumn("turn", turn)
    pick = lambda a, b: F.when(F.col("turn"), F.col(a)).otherwise(F.col(b))
    right = swapped.select("form_id", "kind", pick("given", "sur").alias("sur"), pick("sur", "given").alias("given"), F.when(F.col("turn"), F.lit("full")).otherwise(F.col("gtype")).alias("gtype"), "mid", "canon")
    right = right.withColumn("ini", F.substring("given", 1, 1))
    return parsed.filter("not flip").drop("flip").unionByName(right)


def _near(a: Column, b: Column) -> Column:
    """Within one insertion, deletion, substitution or swap of neighbours."""
    d = F.levenshtein(a, b)
    swap = (d == 2) & (F.length(a) == F.length(b)) & (F.array_sort(F.split(a, "")) == F.array_sort(F.split(b, "")))
    return (d <= 1) | swap


def _holes(word: Column) -> Column:
    """The word and every form of it with one letter left out."""
    return F.array_union(F.array(word), F.transform(F.sequence(F.lit(1), F.length(word)), lambda i: F.concat(F.substring(word, F.lit(1), i - 1), F.substring(word, i + 1, F.length(word)))))


def _profiles(members: DataFrame) -> DataFrame:
    full = F.col("gtype") == "full"
    return members.groupBy("entity").agg(
        F.first("kind").alias("kind"), F.count("*").alias("n"), F.max(full).alias("full"),
        F.collect_set("sur").alias("surs"), F.collect_set(F.when(full, F.col("given"))).alias("givens"),
        F.collect_set(F.when(F.col("mid") != "", F.col("mid"))).alias("mids"), F.max("gtype").alias("gtype"), F.max(F.when(~full, F.col("given"))).alias("short"),
        F.max("ini").alias("ini"), F.first("canon").alias("canon"),
    )


def _links(p: DataFrame) -> DataFrame:
    """``src, dst, rank`` proposed in one round; weak profiles point to full ones."""
    one = p.withColumn("sur", F.explode("surs"))
    full = cut(one.filter("full").withColumn("given", F.explode("givens")).select("entity", "kind", "n", "sur", "given", "mids"))
    weak = one.filter("not full and kind = 'person'")
    key = lambda kind, *parts: F.concat_ws("|", F.lit(kind), *parts)
    none = F.array().cast("array<string>")
    person = F.col("kind") == "person"
    halves = F.when(F.contains("sur", F.lit("-")), F.transform(F.split("sur", "-"), lambda h: key("H", h, F.col("given")))).otherwise(none)
    said = full.filter(person).select(
        "entity",
        F.explode(F.concat(
            F.array(key("N", "sur", "given"), key("A", "sur", F.substring("given", 1, 3)), key("A", "sur", F.substring("given", 1, 4)), key("A", "sur", F.substring("given", 1, 5)), key("I", "sur", F.substring("given", 1, 1))),
            F.transform("mids", lambda m: key("IM", F.col("sur"), F.substring("given", 1, 1), m)),
            F.when(F.size("mids") == 0, F.array(key("I0", "sur", F.substring("given", 1, 1)))).otherwise(F.array(key("E", "sur", "given"))),
            F.transform(_holes(F.col("sur")), lambda h: key("V", F.substring("given", 1, 1), h)), halves,
        )).alias("k"),
    )
    # A block keeps its least and its greatest full profile: it is decisive if they are the same.
    blocks = said.groupBy("k").agg(F.min("entity").alias("lo"), F.max("entity").alias("hi"))

    mid = F.when(F.size("mids") > 0, F.element_at("mids", 1))
    asks = weak.select(
        "entity", "gtype", "sur", "ini", "short",
        F.explode(
            F.when(F.col("gtype") == "nick", F.transform("canon", lambda c: F.struct(F.lit(1).alias("rank"), key("N", F.col("sur"), c).alias("k"))))
            .when(F.col("gtype") == "abbr", F.array(F.struct(F.lit(1).alias("rank"), key("A", "sur", F.substring("short", 1, 5)).alias("k"))))
            .when((F.col("gtype") == "init") & mid.isNotNull(), F.array(F.struct(F.lit(1).alias("rank"), key("IM", "sur", "ini", mid).alias("k")), F.struct(F.lit(2).alias("rank"), key("I0", "sur", "ini").alias("k")), F.struct(F.lit(4).alias("rank"), key("V", "ini", "sur").alias("k"))))
            .when(F.col("gtype") == "init", F.array(F.struct(F.lit(1).alias("rank"), key("I", "sur", "ini").alias("k")), F.struct(F.lit(4).alias("rank"), key("V", "ini", "sur").alias("k"))))
        ).alias("q"),
    ).select("entity", "q.rank", "q.k")
    # Full profiles ask too: without a middle initial for the one that has it, a single surname for the double one.
    asks = asks.unionByName(full.filter(person & (F.size("mids") == 0)).select("entity", F.lit(1).alias("rank"), key("E", "sur", "given").alias("k")))
    asks = asks.unionByName(full.filter(person & ~F.contains("sur", F.lit("-"))).select("entity", F.lit(3).alias("rank"), key("H", "sur", "given").alias("k")))
    answers = asks.distinct().join(blocks, "k").groupBy("entity", "rank").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"))
    # The best ranked question with any answer decides; an unclear answer links nothing.
    first = answers.groupBy("entity").agg(F.min(F.struct("rank", "lo", "hi")).alias("a")).select("entity", "a.*")
    sure = first.filter("lo = hi and lo <> entity").select(F.col("entity").alias("src"), F.col("lo").alias("dst"), "rank")

    # One edit in the surname with the same given name, or in a given name that is no known one.
    support = full.groupBy("given").agg(F.count_distinct("sur").alias("support"))
    family = full.groupBy("sur").agg(F.count_distinct("given").alias("family"))
    named = cut(full.join(support, "given").join(family, "sur"))
    # A known given name outweighs a rare one; else the better supported profile stands.
    own = F.when(F.col("k").startswith("U|"), F.col("support")).otherwise(F.lit(0))
    top = F.struct(own.alias("weight"), "n", F.negative("entity").alias("e"), "sur", "given", "mids", "support", "family").alias("top")
    holes = named.select("entity", "n", "sur", "given", "mids", "support", "family", F.explode(F.concat(F.when(F.length("sur") > 3, F.transform(_holes(F.col("sur")), lambda h: key("T", F.col("given"), h))).otherwise(none), F.when(F.length("given") > 2, F.transform(_holes(F.col("given")), lambda h: key("U", F.col("sur"), h))).otherwise(none))).alias("k"))
    # A block keeps its best profile of all, of each middle initial and of none; a form meets only those its own initials allow.
    offers = F.array_union(F.array(F.lit("*")), F.when(F.size("mids") == 0, F.array(F.lit(""))).otherwise(F.col("mids")))
    meets = F.when(F.size("mids") == 0, F.array(F.lit("*"))).otherwise(F.array_union("mids", F.array(F.lit(""))))
    best = holes.withColumn("m", F.explode(offers)).groupBy("k", "m").agg(F.max(top).alias("top"))
    # The less supported of two moves to the better.
    above = (F.col("top.weight") > own) | (F.col("top.weight") == own) & ((F.col("top.n") > F.col("n")) | (F.col("top.n") == F.col("n")) & (F.negative("top.e") < F.col("entity")))
    alike = holes.withColumn("m", F.explode(meets)).join(best, ["k", "m"]).filter(above & (F.negative("top.e") != F.col("entity")))
    # A misspelt surname brings no given name the right one lacks; a misspelt given name is far rarer than the known one.
    rare = (F.col("support") < F.col("top.support")) & ((F.col("support") < 3) | (5 * F.col("support") < F.col("top.support")))
    in_sur = (F.col("given") == F.col("top.given")) & ((F.col("sur") != F.col("top.sur")) | F.arrays_overlap("mids", "top.mids")) & _near(F.col("sur"), F.col("top.sur"))
    in_given = (F.col("sur") == F.col("top.sur")) & (F.col("given") != F.col("top.given")) & rare & _near(F.col("given"), F.col("top.given"))
    typo = F.when(F.col("k").startswith("T|"), in_sur).otherwise(in_given)
    hits = cut(alike.filter(typo).select("entity", "top", F.arrays_overlap("mids", "top.mids").alias("same"), "given", F.when(F.arrays_overlap("mids", "top.mids"), 0).otherwise(F.least("family", "top.family")).alias("family"), F.least("sur", "top.sur").alias("s1"), F.greatest("sur", "top.sur").alias("s2")).distinct())
    shared = hits.groupBy("s1", "s2").agg(F.count_distinct("given").alias("shared"))
    hits = hits.join(shared, ["s1", "s2"]).filter((F.col("s1") == F.col("s2")) | (F.col("shared") >= F.col("family")))
    near = hits.groupBy(F.col("entity").alias("src")).agg(F.max(F.struct("same", "top")).alias("t")).select("src", F.negative("t.top.e").alias("dst"), F.lit(5).alias("rank"))
    return cut(sure).unionByName(cut(near))


def resolve(forms: DataFrame, key: str = "form_id", text: str = "form_text") -> DataFrame:
    """``form_id, entity``: each spelling's class, named by one of its ids.

    Null, empty and letterless spellings belong to no class and have no row.
    Repeated spellings fall into one class. Ties between equally supported
    names go to the least id. An empty table gives no rows.
    """
    parsed = orient(parse_forms(forms, key, text))
    members = cut(parsed.join(parsed.groupBy("kind", "sur", "given", "gtype", "ini", "mid").agg(F.min("form_id").alias("entity")), ["kind", "sur", "given", "gtype", "ini", "mid"]))
    while True:
        profiles = cut(_profiles(members))
        links = _links(profiles).join(profiles.select(F.col("entity").alias("src"), F.col("full").alias("sf")), "src")
        # Between full profiles the greater id moves, so moves never form a ring; a move waits while its goal moves.
        turned = links.select(F.when(F.col("sf"), F.greatest("src", "dst")).otherwise(F.col("src")).alias("src"), F.when(F.col("sf"), F.least("src", "dst")).otherwise(F.col("dst")).alias("dst"), "rank")
        chosen = cut(turned.groupBy("src").agg(F.min(F.struct("rank", "dst")).alias("c")).select("src", F.col("c.dst").alias("dst")))
        if chosen.isEmpty():
            return members.select("form_id", "entity")
        moves = chosen.join(chosen.select(F.col("src").alias("dst")), "dst", "left_anti")
        members = cut(members.join(moves.select(F.col("src").alias("entity"), "dst"), "entity", "left").withColumn("entity", F.coalesce("dst", "entity")).drop("dst"))


def same_name_pairs(forms: DataFrame, key: str = "form_id", text: str = "form_text") -> DataFrame:
    """``form_a, form_b``: all pairs of spellings of one person or organisation."""
    m = cut(resolve(forms, key, text))
    return m.select(F.col("form_id").alias("form_a"), "entity").join(m.select(F.col("form_id").alias("form_b"), "entity"), "entity").filter("form_a < form_b").select("form_a", "form_b").distinct()

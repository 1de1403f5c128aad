"""Positions of stations from a cache or a gazetteer."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rivulet.functions.geo import geocode_candidates, geocode_simplify
from rivulet.session import new_path

KEYS = ["monitoring_location", "state"]


def join_geocode_cache(df: DataFrame, cache: DataFrame) -> DataFrame:
    """Adds the cached position of each (location, state).

    No broadcast is forced: the cache grows with the data, so Spark compares its size with the
    broadcast threshold and otherwise shuffles, splitting skewed locations.
    """
    found = cache.select(
        *KEYS, F.col("lat").alias("latitude"), F.col("lng").alias("longitude"),
        F.col("query").alias("geocode_query"), F.col("success").alias("geocoded"),
    )
    own = df.drop("latitude", "longitude", "geocode_query", "geocoded")
    return own.join(found, KEYS, "left").withColumn(
        "geocoded", F.coalesce("geocoded", F.lit(False))
    )


def candidate_queries(locations: DataFrame, keep_empty: bool = False) -> DataFrame:
    """Search texts of each location with their rank, best first.

    A location that gives no text has no row, or with ``keep_empty`` one without rank and text.
    """
    every = F.posexplode_outer if keep_empty else F.posexplode
    named = locations.withColumn("_simple", geocode_simplify(F.col("monitoring_location")))
    texts = geocode_candidates(F.col("monitoring_location"), F.col("state"), F.col("_simple"))
    return named.select(*KEYS, every(texts).alias("rank", "query"))


def join_gazetteer_ranked(locations: DataFrame, gazetteer: DataFrame) -> DataFrame:
    """Cache entries for new locations: the first search text the gazetteer knows.

    ``gazetteer`` has one row per query with lat and lng. A location without a hit keeps its first
    search text and success = false, so that it is not looked up again. So does a location without
    name or state, whose missing part is the empty text.
    """
    distinct = locations.select(*[F.coalesce(k, F.lit("")).alias(k) for k in KEYS]).distinct()
    tried = candidate_queries(distinct, keep_empty=True).join(gazetteer, "query", "left")
    hit = F.min(F.when(F.col("lat").isNotNull(), F.struct("rank", "query", "lat", "lng")))
    first = F.min(F.struct("rank", "query"))
    return tried.groupBy(*KEYS).agg(hit.alias("hit"), first.alias("first")).select(
        *KEYS, F.col("hit.lat").alias("lat"), F.col("hit.lng").alias("lng"),
        F.coalesce("hit.query", "first.query").alias("query"),
        F.col("hit").isNotNull().alias("success"),
    )


#: The most edits of a search text and the letters of its place for each edit allowed.
MOST_EDITS, LETTERS_PER_EDIT = 2, 6
#: Up to so many known texts that share a piece are compared with all that hold it.
FEW = 16


def place_and_area(query: Column) -> tuple[Column, Column]:
    """A search text cut before its last two parts (state and country); with fewer parts all is place."""
    pattern = r"^(.*)(, [^,]*, [^,]*)$"
    cut = F.rlike(query, F.lit(pattern))
    return (F.when(cut, F.regexp_extract(query, pattern, 1)).otherwise(query),
            F.when(cut, F.regexp_extract(query, pattern, 2)).otherwise(F.lit("")))


def edits_allowed(place: Column) -> Column:
    return F.least(F.lit(MOST_EDITS), F.floor(F.length(place) / LETTERS_PER_EDIT)).cast("int")


def _kept(df: DataFrame, name: str) -> DataFrame:
    """Written once to the shared folder, as several joins read it."""
    path = new_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _within_reach(given: DataFrame, edits: int) -> DataFrame:
    """Known texts whose length a search text of so many edits may come to."""
    shortest, longest = LETTERS_PER_EDIT * edits - edits, LETTERS_PER_EDIT * (edits + 1) - 1 + edits
    return given.where(F.length("place").between(shortest, longest) if edits < MOST_EDITS else F.length("place") >= shortest)


def _piece(part: int, length: Column, shift: int) -> Column:
    """Key of what stands at the place of one of the MOST_EDITS + 1 pieces that a text of this length is cut into."""
    start = F.floor(length * part / (MOST_EDITS + 1)).cast("int")
    size = F.floor(length * (part + 1) / (MOST_EDITS + 1)).cast("int") - start
    return F.xxhash64("area", length, F.lit(part), F.substring(F.col("place"), start + shift + 1, size))


def _known_pieces(given: DataFrame) -> DataFrame:
    """other_id and the key of each piece of a known text."""
    pieces = [_piece(i, F.length("place"), 0) for i in range(MOST_EDITS + 1)]
    return given.select(F.col("id").alias("other_id"), F.explode(F.array(*pieces)).alias("key"))


def _asked_pieces(asked: DataFrame, lengths: DataFrame) -> DataFrame:
    """id and the keys of all pieces of known texts within MOST_EDITS that a search text may hold unchanged.

    Of the pieces of such a known text one is unchanged and has as many edits before it as pieces, or
    fewer, and so behind it. Its shift is thus at most the pieces before it, and what is left of the
    difference of the lengths is at most the pieces behind it.
    """
    own, length = F.length("place"), F.col("length")
    tried = asked.select("id", "place", "area", F.explode(F.sequence(own - MOST_EDITS, own + MOST_EDITS)).alias("length"))
    pieces = [F.when(F.abs(own - length - s) <= MOST_EDITS - i, _piece(i, length, s))
              for i in range(MOST_EDITS + 1) for s in range(-i, i + 1)]
    return (tried.join(F.broadcast(lengths), "length").select("id", F.explode(F.array(*pieces)).alias("key"))
            .where("key is not null"))


def _left_out(df: DataFrame, edits: int) -> DataFrame:
    """Each way to leave out up to ``edits`` (1 or 2) letters of the place: id, a key of the rest, where and which they are.

    ``at`` holds the positions of both letters, ``out`` the letters, 32 bits each; none is 0.
    """
    place, i, k = F.col("place"), F.col("i"), F.col("k")
    cut = df.select("id", "place", "area", F.explode(F.sequence(F.lit(1), F.length("place") + 1)).alias("i")).select(
        "id", "area", "i", F.ascii(F.substring(place, i, F.lit(1))).alias("a"), (i <= F.length("place")).alias("one"),
        F.substring(place, F.lit(1), i - 1).alias("head"), F.substring(place, i + 1, F.length("place")).alias("tail"))
    tail, size = F.col("tail"), F.length("tail")
    # The second letter is the k-th of those behind the first; k past the end leaves out nothing.
    rows = cut.withColumn("k", F.explode(F.sequence(F.lit(1), size + 1)) if edits > 1 else size + 1)
    rest = F.concat("head", F.substring(tail, F.lit(1), k - 1), F.substring(tail, k + 1, size))

    def two(first: Column, second: Column) -> Column:
        return F.shiftleft(first.cast("bigint"), 32) + second

    at = two(F.when(F.col("one"), i).otherwise(0), F.when(k <= size, i + k).otherwise(0))
    out = two(F.col("a"), F.ascii(F.substring(tail, k, F.lit(1))))
    return rows.select("id", F.xxhash64("area", rest).alias("key"), at.alias("at"), out.alias("out"))


def _met(asked: DataFrame, given: DataFrame, edits: int) -> DataFrame:
    """id and other_id of texts that are 1 to ``edits`` edits apart.

    Such texts are equal once the letters of their edits are left out. A replaced letter is left out of
    both, at the same place but for letters before it that only one text has; so texts that are equal
    in another way are not near, or meet elsewhere too.
    """
    left = _left_out(asked, edits)
    right = _left_out(given, edits).select("key", F.col("id").alias("other_id"), F.col("at").alias("other_at"), F.col("out").alias("other_out"))

    def parts(name: str) -> tuple[Column, Column]:
        return F.shiftright(name, 32), F.col(name).bitwiseAND(0xFFFFFFFF)

    (i, j), (a, b), (k, m), (c, d) = (parts(name) for name in ("at", "out", "other_at", "other_out"))
    near = (F.when((j > 0) & (m > 0), (i == k) & (j == m) & (a != c) & (b != d))
            .when((j > 0) & (k > 0), ((i == k) & (a != c)) | ((j == k + 1) & (b != c)))
            .when((m > 0) & (i > 0), ((i == k) & (a != c)) | ((m == i + 1) & (a != d)))
            .when((i > 0) & (k > 0), F.when(i == k, a != c).otherwise(F.lit(edits > 1)))
            .otherwise((i > 0) | (k > 0)))
    # Each text became many rows, which Spark's estimate of the size does not see: never broadcast.
    return left.join(right.hint("merge"), "key").where(near).select("id", "other_id")


def _candidates(asked: DataFrame, given: DataFrame) -> DataFrame:
    """id and other_id of all search and known texts that are near enough, and of some that are not.

    Texts within two edits share one of three pieces. Where few known texts have a piece, they meet
    there. Search texts and known texts of crowded pieces, and all short ones, which only one edit is
    allowed to, meet where they are equal after letters are left out.
    """
    long, long_asked = _within_reach(given, MOST_EDITS), asked.where(F.col("edits") == MOST_EDITS)
    known = _known_pieces(long)
    uses = known.groupBy("key").agg(F.count("*").alias("uses"))
    few, many = uses.where(F.col("uses") <= FEW), uses.where(F.col("uses") > FEW)
    pieces = _asked_pieces(long_asked, long.select(F.length("place").alias("length")).distinct())
    met = pieces.join(few, "key").join(known, "key").select("id", "other_id")
    crowded = long_asked.join(pieces.join(many, "key").select("id").distinct(), "id", "left_semi")
    crowd = long.join(known.join(many, "key").select(F.col("other_id").alias("id")).distinct(), "id", "left_semi")
    short = _met(asked.where(F.col("edits") == 1), _within_reach(given, 1), 1)
    return met.unionByName(short).unionByName(_met(crowded, crowd, MOST_EDITS)).distinct()


def similar_places(queries: DataFrame, known: DataFrame) -> DataFrame:
    """text, match and distance (edits, 1 or more) of search texts and known texts that are nearly equal.

    The last two parts of both, state and country, are equal, and the places before them are at most
    as many edits apart as the search text's place allows: one for every six letters, two at most.
    No pair is lost. What a text costs does not grow with the texts that are like it in parts only:
    see ``_candidates``. Keys and ids are hashes; equal ones of different texts only add
    comparisons, as every pair is compared by its texts. The edit distance stops at the bound.
    """
    def side(df: DataFrame) -> DataFrame:
        place, area = place_and_area(F.col("text"))
        return df.select(F.col("query").alias("text")).where("text is not null").distinct().select(
            F.xxhash64("text").alias("id"), place.alias("place"), area.alias("area"))

    asked = _kept(side(queries).withColumn("edits", edits_allowed(F.col("place"))).where("edits > 0"), "search-texts")
    given = _kept(side(known), "known-texts")
    others = given.select(F.col("id").alias("other_id"), F.col("place").alias("other"), F.col("area").alias("other_area"))
    pairs = _candidates(asked, given).join(others, "other_id").join(asked, "id").where("area = other_area")
    return pairs.withColumn("distance", F.expr("levenshtein(place, other, edits)")).where("distance > 0").select(
        F.concat("place", "area").alias("text"), F.concat("other", "area").alias("match"), "distance")


def join_gazetteer_fuzzy(locations: DataFrame, gazetteer: DataFrame) -> DataFrame:
    """Like ``join_gazetteer_ranked``, but a search text also finds known texts with small misspellings.

    The best hit has the smallest rank of the search text, then the fewest edits, then the first
    known text; ``matched`` and ``distance`` name it. Each distinct search text is compared once,
    however many locations share it.
    """
    distinct = locations.select(*[F.coalesce(k, F.lit("")).alias(k) for k in KEYS]).distinct()
    tried = _kept(candidate_queries(distinct, keep_empty=True), "tried-texts")
    known = gazetteer.where(F.col("lat").isNotNull())
    equal = tried.select("query").distinct().join(known.select("query"), "query").distinct().select(
        F.col("query").alias("text"), F.col("query").alias("match"), F.lit(0).alias("distance"))
    near = similar_places(tried, known).unionByName(equal).groupBy("text").agg(
        F.min(F.struct("distance", "match")).alias("best")).select("text", "best.*")
    placed = near.join(known.select(F.col("query").alias("match"), "lat", "lng"), "match").groupBy("text").agg(
        F.min(F.struct("distance", "match", "lat", "lng")).alias("found"))
    found = F.struct(F.col("rank"), F.col("found.distance"), F.col("found.match").alias("matched"),
                     F.col("found.lat"), F.col("found.lng"), F.col("query"))
    best = tried.join(placed, tried["query"] == placed["text"], "left").groupBy(*KEYS).agg(
        F.min(F.when(F.col("found").isNotNull(), found)).alias("hit"), F.min(F.struct("rank", "query")).alias("first"))
    return best.select(
        *KEYS, F.col("hit.lat").alias("lat"), F.col("hit.lng").alias("lng"),
        F.coalesce("hit.query", "first.query").alias("query"), F.col("hit.matched").alias("matched"),
        F.col("hit.distance").alias("distance"), F.col("hit").isNotNull().alias("success"))


def failed_locations(df: DataFrame) -> DataFrame:
    """Stations, each once, that no position was found for."""
    return df.filter(~F.col("geocoded")).select("stn_code", "monitoring_location").distinct()

"""Topic classification by rules: pattern hits, keyword hits, confidence, decision, and later validation.

All topics are scored in one projection, without a shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lontar.functions.text import pieces, strip

#: Characters between words.
NO_LETTER = r"[^\p{L}\p{N}_]"

#: Topic, its subdomain, its patterns (word alternatives) and its keywords, in order (fixed values).
TOPICS = (
    ("daily_life_tips", "general_tips", (r"tip|hack|advice|guide|how\s+to|life\s+hack|helpful|useful", "easy|simple|quick|efficient|better|improve", "everyday|daily|routine|habit|lifestyle"), ("tip", "hack", "advice", "guide", "how to", "life hack")),
    ("cooking_techniques", "culinary_skills", ("cook|recipe|bake|fry|boil|steam|grill|roast|sauté|simmer", "technique|method|preparation|ingredient|seasoning", "kitchen|culinary|chef|cooking|food"), ("cook", "recipe", "bake", "fry", "boil", "steam", "technique")),
    ("home_care", "household_maintenance", ("clean|maintain|repair|organize|home|house|household", "maintenance|upkeep|care|preservation|storage", "furniture|appliance|room|space|interior"), ("clean", "maintain", "repair", "organize", "home", "house")),
    ("object_usage_and_actions", "tool_usage", ("use|operate|handle|manipulate|tool|device|gadget", "function|purpose|application|utility|operation", "instructions|manual|guide|directions"), ("use", "operate", "handle", "manipulate", "tool")),
    ("personal_care", "self_maintenance", ("hygiene|grooming|health|wellness|self-care|skincare", "beauty|cosmetic|personal|body|face|hair", "routine|regimen|treatment|care|maintenance"), ("hygiene", "grooming", "health", "wellness", "self-care")),
    ("healthy_alternatives", "health_choices", ("healthy|alternative|substitute|natural|organic|wholesome", "nutrition|nutritious|diet|wellness|health", "replace|swap|instead|better|healthier"), ("healthy", "alternative", "substitute", "natural", "organic")),
    ("cleaning_techniques", "sanitation_methods", ("clean|wash|scrub|sanitize|disinfect|polish|wipe", "cleaning|cleaner|detergent|soap|solution", "stain|dirt|grime|mess|spot|residue"), ("clean", "wash", "scrub", "sanitize", "disinfect")),
    ("object_placement", "organization_systems", ("organize|arrange|place|position|store|storage", "organization|arrangement|placement|layout|setup", "shelf|cabinet|drawer|container|space"), ("organize", "arrange", "place", "position", "store")),
    ("food_handling", "food_safety", (r"food\s+safety|handling|storage|preparation|preservation", "fresh|spoilage|expiration|contamination|hygiene", "refrigerate|freeze|store|keep|maintain"), ("food safety", "storage", "handling", "preparation")),
    ("crafting_and_diy", "creative_projects", ("craft|diy|make|create|build|handmade|homemade", "project|tutorial|instructions|materials|supplies", "creative|artistic|design|decoration|decor"), ("craft", "diy", "make", "create", "build", "handmade")),
    ("odor_removal", "scent_management", ("odor|smell|deodorize|freshen|eliminate|neutralize", r"fragrance|scent|aroma|air\s+freshener|perfume"), ("odor", "smell", "deodorize", "freshen", "eliminate")),
    ("food_preservation", "food_storage", ("preserve|store|freeze|can|pickle|dry|cure", r"preservation|storage|shelf\s+life|expiration"), ("preserve", "store", "freeze", "can", "pickle")),
    ("object_modification", "item_customization", ("modify|alter|customize|adapt|change|transform", "modification|alteration|customization|upgrade"), ("modify", "alter", "customize", "adapt", "change")),
    ("object_storage", "storage_solutions", ("store|storage|organize|container|shelf|cabinet", "organization|arrangement|space|room|closet"), ("store", "organize", "container", "shelf", "cabinet")),
    ("object_shapes_and_functions", "design_analysis", ("shape|function|purpose|design|form|structure", "geometry|dimension|size|appearance|feature"), ("shape", "function", "purpose", "design")),
    ("food_allergy_substitutions", "dietary_alternatives", ("allergy|substitute|alternative|replace|intolerance", "gluten-free|dairy-free|nut-free|vegan|substitution"), ("allergy", "substitute", "alternative", "replace")),
    ("personal_hygiene", "cleanliness_practices", ("hygiene|wash|brush|shower|clean|bathe", "dental|oral|body|personal|cleanliness"), ("hygiene", "wash", "brush", "shower", "clean")),
    ("carrying_objects", "transport_methods", ("carry|transport|move|lift|handle|grip", "bag|container|holder|carrier|support"), ("carry", "transport", "move", "lift", "handle")),
    ("food_preparation", "cooking_prep", ("prep|prepare|chop|slice|mix|blend|combine", "preparation|cooking|kitchen|ingredient|recipe"), ("prep", "prepare", "chop", "slice", "mix")),
    ("healthy_drinks", "beverage_wellness", ("drink|beverage|smoothie|juice|tea|water|healthy", "hydration|nutrition|vitamin|antioxidant|wellness"), ("drink", "beverage", "smoothie", "juice", "tea")),
    ("food_seasoning", "flavor_enhancement", ("season|spice|flavor|salt|pepper|herb|seasoning", "taste|flavoring|condiment|marinade|sauce"), ("season", "spice", "flavor", "salt", "pepper")),
    ("reasoning_about_object_functions", "functional_analysis", ("function|purpose|why|how|reason|logic|analysis", "understanding|explanation|rationale|principle"), ("function", "purpose", "why", "how", "reason")),
)
#: Words of topics that are not wanted (fixed values).
EXCLUDED = (
    "news|politics|election|government|war|violence", r"celebrity|gossip|entertainment|movie|tv\s+show", "sports|game|match|tournament|league", "investment|stock|crypto|finance|money|business",
    "medical|diagnosis|treatment|prescription|drug", "legal|law|court|lawsuit|attorney",
)
#: Words of promotion (fixed values).
PROMOTION = ("buy|purchase|order|sale|discount|offer|deal", "click|visit|website|link|url|www", "affiliate|sponsored|advertisement|promo")


def _hits(text: Column, pattern: str) -> Column:
    return F.regexp_count(text, F.lit(rf"\b(?:{pattern})\b"))


def _substrings(text: Column, word: str) -> Column:
    """Non-overlapping occurrences, within words too."""
    return ((F.length(text) - F.length(F.replace(text, F.lit(word), F.lit("")))) / F.lit(len(word))).cast("int")


def scores(title: Column, content: Column) -> Column:
    """Array of ``struct(score, rank, topic)`` in the order of the topics; ``rank`` falls, so the first topic wins a tie.

    The text is cut into words once, of which those of any topic are kept;
    alternatives that are single words are counted among these by membership,
    only phrases and hyphenated ones by pattern.
    """
    full = F.lower(F.concat(F.coalesce(title, F.lit("")), F.lit(" "), content))
    single = sorted({a for _, _, patterns, _ in TOPICS for p in patterns for a in p.split("|") if a.isalpha()})
    parts = F.struct(full.alias("full"), F.filter(F.split(full, NO_LETTER + "+"), lambda w: w.isin(*single)).alias("words"), pieces(full).alias("size"))
    return F.transform(F.array(parts), _all_scores)[0]


def _members(words: Column, chosen: list[str]) -> Column:
    return F.size(F.filter(words, lambda w: w.isin(*chosen)))


def _all_scores(text: Column) -> Column:
    full, size = text["full"], text["size"]
    weight = F.when(size > 0, F.log(size + 1.0)).otherwise(F.lit(1.0))
    out = []
    for rank, (topic, _, patterns, keywords) in enumerate(TOPICS):
        alternatives = [a for p in patterns for a in p.split("|")]
        single = [a for a in alternatives if a.isalpha()]
        hits = 2 * _members(text["words"], list(dict.fromkeys(single)))
        for a in [a for a in alternatives if not a.isalpha()] + [a for a in dict.fromkeys(single) if single.count(a) > 1]:
            hits = hits + 2 * _hits(full, a)
        for w in keywords:
            hits = hits + _substrings(full, w)
        out.append(F.struct(F.round(hits / weight, 9).alias("score"), F.lit(-rank).alias("rank"), F.lit(topic).alias("topic")))
    return F.array(*out)


def matched_keywords(title: Column, content: Column) -> Column:
    """Sorted keywords that occur."""
    full = F.lower(F.concat(F.coalesce(title, F.lit("")), F.lit(" "), content))
    every = sorted({w for t in TOPICS for w in t[3]})
    return F.array_compact(F.array(*(F.when(full.contains(w), F.lit(w)) for w in every)))


def subdomain(topic: Column) -> Column:
    table = F.create_map(*(F.lit(x) for t in TOPICS for x in t[:2]))
    return F.coalesce(table[topic], topic)


def classify(df: DataFrame, title: str, content: str) -> DataFrame:
    """``df`` with ``topic, confidence, subdomain, rule_score, is_allowed, rejection_reason``, before validation.

    Null and blank contents are rejected as ``empty_content``.
    """
    ranked = df.withColumn("_s", F.sort_array(scores(F.col(title), F.col(content)), asc=False)).withColumns({"_b": F.col("_s")[0], "_r": F.col("_s")[1]["score"]})
    best = F.col("_b")["score"]
    confidence = F.when(F.col("_r") == 0, F.least(best / 5.0, F.lit(1.0))).otherwise(F.least(best / F.col("_r") / 3.0, F.lit(1.0)))
    empty = F.coalesce(strip(F.col(content)) == "", F.lit(True))
    none = best == 0
    low = confidence < 0.3
    reason = F.when(empty, "empty_content").when(none, "no_matching_topics").when(low, F.concat(F.lit("low_confidence_"), F.format_string("%.2f", confidence)))
    return ranked.withColumns({
        "rejection_reason": reason, "is_allowed": reason.isNull(), "topic": F.when(reason.isNull(), F.col("_b")["topic"]), "subdomain": F.when(~empty & ~none, subdomain(F.col("_b")["topic"])),
        "confidence": F.when(empty | none, 0.0).otherwise(confidence), "rule_score": F.when(empty, 0.0).otherwise(best),
    }).drop("_s", "_b", "_r")


def excluded(title: Column, content: Column) -> Column:
    full = F.lower(F.concat(F.coalesce(title, F.lit("")), F.lit(" "), content))
    return full.rlike(rf"\b(?:{'|'.join(EXCLUDED)})\b")


def low_quality(content: Column) -> Column:
    """Too short, promotional, all in capitals, or repeating its sentences."""
    text = F.coalesce(content, F.lit(""))
    promotion = sum((_hits(F.lower(text), p) for p in PROMOTION[1:]), _hits(F.lower(text), PROMOTION[0]))
    size = pieces(text)
    parts = F.split(text, r"\.")
    unique = F.size(F.array_distinct(F.transform(parts, lambda s: F.lower(strip(s)))))
    shouting = (F.upper(text) == text) & (F.lower(text) != text) & (F.length(text) > 50)
    return (F.length(strip(text)) < 100) | ((size > 0) & (promotion / F.greatest(size, F.lit(1)) > 0.1)) | shouting | ((F.size(parts) > 3) & (unique / F.size(parts) < 0.7))


def validated(classified: DataFrame, title: str, content: str) -> DataFrame:
    """``classified`` after the checks for unwanted topics and low quality, which only see what was allowed."""
    reason = F.when(F.col("is_allowed") & excluded(F.col(title), F.col(content)), "excluded_topic").when(F.col("is_allowed") & low_quality(F.col(content)), "low_quality")
    marked = classified.withColumn("_why", reason)
    gone = F.col("_why").isNotNull()
    return marked.withColumns({
        "topic": F.when(~gone, F.col("topic")), "subdomain": F.when(~gone, F.col("subdomain")), "confidence": F.when(gone, 0.0).otherwise(F.col("confidence")), "is_allowed": F.col("is_allowed") & ~gone,
        "rejection_reason": F.coalesce("_why", "rejection_reason"),
    }).drop("_why")


def topic_info(topic: str) -> dict | None:
    """What is known of a topic: its subdomain, patterns and keywords; None for an unknown one."""
    return next(({"topic": t, "subdomain": sub, "patterns": list(patterns), "keywords": list(words)} for t, sub, patterns, words in TOPICS if t == topic), None)


def keyword_index(spark) -> DataFrame:
    """``keyword, topic``: the inverted index of keywords (a few dozen rows)."""
    return spark.createDataFrame([(w, t[0]) for t in TOPICS for w in t[3]], "keyword string, topic string")

"""Sentences, words, counts, top lists and pooled frequencies."""

from pyspark.sql import functions as F

from hubbub.functions.text import is_term, sentences
from hubbub.operators import counts, entities, filters, segment, units
from hubbub.operators.ranking import first_match
from hubbub.sources.lexicon import weighted_dictionary
from workload.base import (
    SQL_LEXICON, SQL_STOP, STOP, benchmark_lexicon, query, sql_is_term, sql_segments, sql_sentences, sql_tokens, table,
    talk_units, texts,
)

STEP = 1 << 32


def talk_tokens(spark, sf_dir):
    return filters.keep_terms(units.token_rows(talk_units(spark, sf_dir)), STOP)


def document_tokens(spark, sf_dir):
    docs = texts(spark, sf_dir, "documents", "doc_id").select("doc_id", F.lit(0).alias("unit_ix"), "text")
    return units.token_rows(docs)


SQL_TALK_TOKENS = f"""
raw as ({sql_tokens('conversations', 'conv_id, turn', 'text')}),
tokens as (select conv_id, turn, word, turn::bigint * {STEP} + tok_ix as pos from raw
  where {sql_is_term('word')} and word not in {SQL_STOP})
"""
SQL_DOC_TOKENS = f"""
raw as ({sql_tokens('documents', 'doc_id', 'text')}),
tokens as (select doc_id, word, tok_ix::bigint as pos from raw where {sql_is_term('word')})
"""


@query(f"""with pieces as (select conv_id, turn, {sql_sentences('text')} as s from conversations)
select conv_id, turn as unit_ix, unnest(range(len(s)))::bigint as sent_ix, unnest(s) as sentence from pieces""",
       name="sentences")
def sentence_rows(spark, sf_dir):
    rows = units.sentence_rows(talk_units(spark, sf_dir))
    return rows.withColumn("sent_ix", F.col("sent_ix").cast("bigint"))


@query(f"with {SQL_TALK_TOKENS} select conv_id, word, count(*) as n, min(pos) as first_pos from tokens where turn = 0 group by 1, 2")
def term_counts_body(spark, sf_dir):
    return counts.term_counts(talk_tokens(spark, sf_dir).where("unit_ix = 0"), ["conv_id"])


@query(f"with {SQL_TALK_TOKENS} select conv_id, word, count(*) as n, min(pos) as first_pos from tokens where turn > 0 group by 1, 2")
def term_counts_comments(spark, sf_dir):
    return counts.term_counts(talk_tokens(spark, sf_dir).where("unit_ix > 0"), ["conv_id"])


def _sql_top(tokens, where, key, n):
    return f"""with {tokens}, c as (select {key}, word, count(*) as n, min(pos) as first_pos from tokens {where} group by 1, 2),
r as (select {key}, word, n, row_number() over (partition by {key} order by n desc, first_pos) as rank from c)
select {key}, word, n, rank::bigint as rank from r where rank <= {n}"""


def _ranked(df, key):
    return df.select(key, "word", "n", F.col("rank").cast("bigint").alias("rank"))


@query(_sql_top(SQL_DOC_TOKENS, "", "doc_id", counts.TOP_WORDS))
def top_terms_per_article(spark, sf_dir):
    return _ranked(counts.top_words_per_text(texts(spark, sf_dir, "documents", "doc_id")), "doc_id")


@query(_sql_top(SQL_TALK_TOKENS, "where turn > 0", "conv_id", counts.TOP_WORDS))
def top_terms_comments(spark, sf_dir):
    tokens = talk_tokens(spark, sf_dir).where("unit_ix > 0")
    return _ranked(counts.top_terms(counts.term_counts(tokens, ["conv_id"]), ["conv_id"]), "conv_id")


@query(f"""with {SQL_DOC_TOKENS}, both_ as (
  select word from tokens where word not in {SQL_STOP}
  union all select word from (select unnest({sql_sentences('text')}) as word from benchmark)
  where {sql_is_term('word')} and word not in {SQL_STOP}),
top as (select word, count(*) as n from both_ group by 1 order by n desc, word limit 80)
select word, n, round(n / max(n) over (), 6) as weight from top""")
def pooled_frequencies_top80(spark, sf_dir):
    bodies = document_tokens(spark, sf_dir).select("word")
    other = table(spark, sf_dir, "benchmark").select(F.explode(sentences("text")).alias("word"))
    pooled = filters.keep_terms(bodies.unionByName(other), STOP)
    return counts.pooled_frequencies(pooled).withColumn("weight", F.round("weight", 6))


@query(f"""with {SQL_DOC_TOKENS}, stops as (select distinct unnest({sql_sentences('text')}) as word from benchmark)
select doc_id, word, count(*) as n from tokens t anti join stops s on t.word = s.word group by 1, 2""")
def stopword_filtered_terms(spark, sf_dir):
    """Stop words as a table: every word of the benchmark texts."""
    stop = table(spark, sf_dir, "benchmark").select(F.explode(sentences("text")).alias("word"))
    return filters.keep_terms(counts.words_per_text(texts(spark, sf_dir, "documents", "doc_id")), stop).select("doc_id", "word", "n")


@query(f"""with {SQL_DOC_TOKENS}, {SQL_LEXICON}
select coalesce(tag, 'x') as pos_tag, section, count(*) as n, count(distinct doc_id) as docs
from tokens t left join lexicon l on t.word = l.word group by 1, 2""")
def lexicon_tagged_terms(spark, sf_dir):
    # Per document and word first, so the dictionary is asked once for each pair.
    pairs = counts.words_per_text(texts(spark, sf_dir, "documents", "doc_id"))
    tagged = filters.tag_words(pairs, benchmark_lexicon(spark, sf_dir))
    per_doc = tagged.groupBy("pos_tag", "section", "doc_id").agg(F.sum("n").alias("n"))
    return per_doc.groupBy("pos_tag", "section").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("docs"))


@query(f"""with {SQL_DOC_TOKENS}, {SQL_LEXICON}
select doc_id, t.word, count(*) as n from tokens t join lexicon l on t.word = l.word
where tag like 'N%' or tag like 'V%' group by 1, 2""")
def pos_filtered_terms(spark, sf_dir):
    """Words the dictionary tags as nouns or verbs."""
    pairs = counts.words_per_text(texts(spark, sf_dir, "documents", "doc_id"))
    tagged = filters.tag_words(pairs, benchmark_lexicon(spark, sf_dir))
    return tagged.where(filters.is_content_tag(F.col("pos_tag"))).select("doc_id", "word", "n")


@query(f"""with {SQL_DOC_TOKENS}, {SQL_LEXICON}
select t.doc_id, section, t.word, count(*) as n from tokens t join lexicon l on t.word = l.word
where section = 'NAMES' group by all""")
def gazetteer_hits(spark, sf_dir):
    pairs = counts.words_per_text(texts(spark, sf_dir, "documents", "doc_id"))
    return filters.gazetteer_hits(pairs, benchmark_lexicon(spark, sf_dir), ["NAMES"])


def benchmark_names(spark, sf_dir):
    """Names of two words that follow each other in a benchmark text, each with a section from its first letter."""
    words = F.filter(F.split("text", "[ \\t\\n\\r]+"), lambda w: w != "")
    pairs = F.transform(F.slice("words", F.lit(2), F.greatest(F.size("words") - 1, F.lit(0))), lambda w, i: F.concat(F.get("words", i), F.lit(" "), w))
    names = table(spark, sf_dir, "benchmark").select(words.alias("words")).select(F.explode(pairs).alias("word"))
    names = names.where(F.col("word").rlike("^[A-Za-z0-9]+ [A-Za-z0-9]+$")).distinct()
    return names.withColumn("section", F.when(F.col("word") < "h", "PEOPLE").when(F.col("word") < "p", "PLACES").otherwise("BRANDS"))


# A name is a run of ASCII letters and digits, a blank and another such run, so it is three runs of a text.
SQL_ENTITIES = r"""
with recursive raw as (select list_filter(regexp_split_to_array(text, '[ \t\n\r]+'), lambda x: x <> '') as words from benchmark),
names as (select distinct unnest(list_transform(range(2, len(words) + 1), lambda i: words[i - 1] || ' ' || words[i])) as name from raw),
known as (
  select name, case when name < 'h' then 'PEOPLE' when name < 'p' then 'PLACES' else 'BRANDS' end as section
  from names where regexp_matches(name, '^[A-Za-z0-9]+ [A-Za-z0-9]+$')),
d as (select row_number() over () as row_, doc_id, regexp_extract_all(text, '[A-Za-z0-9]+|[^A-Za-z0-9]+') as runs from documents),
r as (select row_, unnest(range(1, len(runs) + 1)) as i, unnest(runs) as run from d),
o as (
  select row_, run || lead(run, 1) over w || lead(run, 2) over w as name,
    coalesce(sum(length(run)) over (partition by row_ order by i rows between unbounded preceding and 1 preceding), 0)::integer as spot
  from r window w as (partition by row_ order by i)),
ranked as (
  select row_, spot, spot + length(name) as past, section, name, row_number() over (partition by row_ order by spot) as k,
    lag(spot, 1, -1) over (partition by row_ order by spot) as before from o join known using (name)),
kept as (
  select row_, spot, past, section, name from ranked where k = 1
  union all
  select n.row_, n.spot, n.past, n.section, n.name from kept join ranked n on n.row_ = kept.row_ and n.spot >= kept.past and n.before < kept.past)
select doc_id, spot::integer as "start", past::integer as "end", section, name from kept join d using (row_)"""


@query(SQL_ENTITIES)
def entity_spans(spark, sf_dir):
    """Where names of two words stand in every document."""
    return entities.entity_spans(texts(spark, sf_dir, "documents", "doc_id"), benchmark_names(spark, sf_dir), ["doc_id"])


@query(SQL_ENTITIES)
def entity_spans_by_join(spark, sf_dir):
    """The same by join, the way of lists too large to send."""
    return entities.entity_spans(texts(spark, sf_dir, "documents", "doc_id"), benchmark_names(spark, sf_dir), ["doc_id"], small=False)


@query(r"""with s as (select doc_id, unnest(""" + sql_sentences("text") + r""") as sentence from documents),
w as (select doc_id, unnest(regexp_extract_all(sentence, '[a-zA-Z0-9]+(?:\.[0-9]+)?%?|[+#&._%-]+|[^a-zA-Z0-9+#&._%-]')) as word from s)
select doc_id, word, count(*) as n from w group by 1, 2""")
def segmented_terms(spark, sf_dir):
    """Segmentation without a dictionary: Latin and digit runs stay whole, other letters stand alone."""
    docs = texts(spark, sf_dir, "documents", "doc_id").select("doc_id", F.lit(0).alias("unit_ix"), "text")
    tokens = units.token_rows(segment.segment(docs, keys=["doc_id"]), segment.words())
    return tokens.groupBy("doc_id", "word").agg(F.count(F.lit(1)).alias("n"))


SQL_SEGMENTED = f"""with recursive {SQL_LEXICON}, {sql_segments('documents')},
said as (select doc_id, unnest(b) as block, unnest(range(len(b))) as place
  from (select doc_id, regexp_extract_all(text, '[一-鿕a-zA-Z0-9+#&._%-]+') as b from documents)),
kept as (select doc_id, word, row_number() over (partition by doc_id order by place, i) - 1 as pos
  from said join cut using (block) where length(word) > 1 and (tag like 'N%' or tag like 'V%'))
select doc_id, word, count(*) as n, min(pos)::bigint as first_pos from kept group by 1, 2"""


def _segmented_terms(spark, sf_dir, small):
    docs = texts(spark, sf_dir, "documents", "doc_id").select("doc_id", F.lit(0).alias("unit_ix"), "text")
    cut = segment.segment(docs, benchmark_lexicon(spark, sf_dir), ["doc_id"], small=small)
    tokens = units.token_rows(cut, filters.content_words(F.col("tagged")))
    return counts.term_counts(tokens, ["doc_id"])


@query(SQL_SEGMENTED)
def segmented_terms_lexicon(spark, sf_dir):
    """Segmentation with a weighted dictionary, nouns and verbs kept."""
    return _segmented_terms(spark, sf_dir, None)


@query(f"""with recursive {SQL_LEXICON.replace('count(*)::double as weight', '1.0::double as weight')}, {sql_segments('documents')},
said as (select unnest(regexp_extract_all(text, '[一-鿕a-zA-Z0-9+#&._%-]+')) as block from documents),
counted as (select word, count(*) as n from said join cut using (block) group by word)
select l.word, tag, greatest(coalesce(n, 1), 1)::double as weight from lexicon l left join counted c on c.word = l.word""")
def estimated_weights(spark, sf_dir):
    """Weights of a word list without any, estimated from the documents."""
    docs = texts(spark, sf_dir, "documents", "doc_id").select("doc_id", F.lit(0).alias("unit_ix"), "text")
    return segment.estimated(docs, benchmark_lexicon(spark, sf_dir)).select("word", "tag", "weight")


# Words with weights and tags as a caller writes them: what is empty or no number falls out.
WEIGHTS = {"the": 8, "er": 2.5, "ing": 3, "th": 1, "re": 4, "": 9, "and": "many", "of": True, "on": None}
TAGS = {"the": "P", "ing": "VA", "re": "Na"}
WEIGHED = ("the", "er", "ing", "th", "re")
_KEPT = ", ".join(f"('{w}', {float(WEIGHTS[w])}::double, {repr(TAGS[w]) if w in TAGS else 'null'})" for w in WEIGHED)


@query(f"""with recursive lexicon as (select * from (values {_KEPT}) as t(word, weight, tag)), {sql_segments('conversations')},
said as (select unnest(regexp_extract_all(text, '[一-鿕a-zA-Z0-9+#&._%-]+')) as block from conversations)
select word, tag, count(*) as n from said join cut using (block) where length(word) > 1 group by 1, 2""")
def weighted_words(spark, sf_dir):
    """How often each word of a dictionary given as a map is cut out."""
    talks = talk_units(spark, sf_dir)
    cut = segment.segment(talks, weighted_dictionary(spark, WEIGHTS, TAGS), ["conv_id"])
    rows = cut.select(F.explode("tagged").alias("t")).select("t.word", F.col("t.pos").alias("tag")).where(F.col("word").isin(*WEIGHED))
    return rows.groupBy("word", "tag").agg(F.count(F.lit(1)).alias("n"))


@query(SQL_SEGMENTED)
def segmented_terms_by_join(spark, sf_dir):
    """The same by join, the way of dictionaries too large to send."""
    return _segmented_terms(spark, sf_dir, False)


@query(f"""with t as (select conv_id, turn, text, list_filter({sql_sentences('text')}, lambda x: {sql_is_term('x')}) as words from conversations),
z as (select conv_id, turn, words[1:len(string_split(text, chr(10)))] as words, string_split(text, chr(10)) as lines from t)
select conv_id, turn, len(words)::bigint as zipped, coalesce(array_to_string(words, ' '), '') as paired,
  list_filter(words, lambda x: length(x) > 6)[1] as first_long from z where len(words) > 0""")
def zip_and_first_match(spark, sf_dir):
    """Words zipped with lines up to the shorter list, empty results dropped, first long word kept."""
    talks = table(spark, sf_dir, "conversations")
    words, lines = F.filter(sentences("text"), is_term), F.split("text", "\n")
    zipped = talks.select("conv_id", "turn", filters.zip_tags(words, lines).alias("z")).where(F.size("z") > 0)
    paired = F.transform("z", lambda p: p["word"])
    return zipped.select(
        "conv_id", "turn", F.size("z").cast("bigint").alias("zipped"), F.array_join(paired, " ").alias("paired"),
        first_match(paired, lambda w: F.char_length(w) > 6).alias("first_long"),
    )

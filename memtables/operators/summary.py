"""The extractive reply over found chunks (33): of the sentences of a request's results, the most central
ones that fit a length, in the order in which they were found."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from memtables.functions.text import tokens

#: the longest reply, in code points
REPLY_CHARS = 400
#: words up to and with the marks that end them
SENTENCE = r"[^.!?]+[.!?]*"
_REQUESTS = 256                   # requests whose words are counted at once inside one task


def _sentences(texts: Column) -> Column:
    """The distinct sentences of an array of texts, in the order in which they were found."""
    cut = F.transform(texts, lambda t: F.regexp_extract_all(F.coalesce(t, F.lit("")), F.lit(SENTENCE), F.lit(0)))
    return F.array_distinct(F.transform(F.flatten(cut), lambda s: F.trim(F.regexp_replace(s, r"[ \t\n\r\f]+", " "))))


def _taken(words: pa.ListArray, lengths: pa.ListArray, chars: int) -> list[list[int]]:
    """Per request the numbers of the sentences that its reply takes."""
    n_sentences = pc.fill_null(pc.list_value_length(words), 0).to_numpy(zero_copy_only=False)
    sentences = words.flatten()
    n_words = pc.fill_null(pc.list_value_length(sentences), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    word = sentences.flatten().dictionary_encode()
    request = np.repeat(np.arange(len(words)), n_sentences)
    place = np.arange(len(request)) - np.repeat(np.cumsum(n_sentences) - n_sentences, n_sentences)
    sentence = np.repeat(np.arange(len(request)), n_words)
    pair = request[sentence] * max(len(word.dictionary), 1) + word.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    _, which, held = np.unique(pair, return_inverse=True, return_counts=True)
    total = np.bincount(sentence, weights=held[which], minlength=len(request))
    score = total * total / np.maximum(n_words, 1)
    best = np.lexsort((place, -score, request))
    best = best[n_words[best] > 0]                # a sentence without a word doesn't count
    first = np.searchsorted(request[best], request[best])
    upto = np.cumsum(lengths.flatten().to_numpy(zero_copy_only=False).astype(np.int64)[best] + 1)
    upto -= np.concatenate([[0], upto])[first]
    best = np.sort(best[(np.arange(len(best)) == first) | (upto - 1 <= chars)])
    ends = np.searchsorted(request[best], np.arange(1, len(words)))
    return [x.tolist() for x in np.split(place[best], ends)]


def _taken_udf(chars: int):
    @F.arrow_udf(T.ArrayType(T.IntegerType()))
    def taken(words: pa.Array, lengths: pa.Array) -> pa.Array:
        out = []
        for i in range(0, len(words), _REQUESTS):
            out += _taken(words.slice(i, _REQUESTS), lengths.slice(i, _REQUESTS), chars)
        return pa.array(out, pa.list_(pa.int32()))
    return taken


def with_reply(requests: DataFrame, texts: Column, chars: int = REPLY_CHARS) -> DataFrame:
    """Adds ``abstract_reply`` of ``texts``, the array of a request's found texts in rank order.

    A sentence's centrality is the squared cosine (but for a constant of the request) between its set of
    words and the sum of all sentences' sets: (sum over its words of the sentences that hold the word)^2 / its
    number of words. Sentences are taken by centrality (ties: first found) while they fit ``chars``; the first
    is cut if it alone doesn't. A sentence found several times counts once; one without a word doesn't count.
    Without such a sentence (null or empty texts, too) the reply is null.

    A request holds at most k texts, and its words are counted where its row stands: they are never rows of
    their own, so nothing is sorted or spilled that is larger than the texts.
    """
    out = requests.withColumn("_said", _sentences(texts))
    out = out.withColumn("_taken", _taken_udf(chars)(F.transform("_said", tokens), F.transform("_said", F.length)))
    said = F.transform("_taken", lambda i: F.substring(F.get(F.col("_said"), i), 1, chars))
    return out.withColumn("abstract_reply", F.when(F.size("_taken") > 0, F.array_join(said, " "))).drop("_said", "_taken")


def summaries(results: DataFrame, chars: int = REPLY_CHARS) -> DataFrame:
    """``query_id, abstract_reply`` (:func:`with_reply`) of results ``query_id, rank, chunk_text``; requests
    without a reply have no row. The results are shuffled once, by request."""
    found = F.array_sort(F.collect_list(F.struct("rank", "chunk_text")))
    texts = results.repartition("query_id").groupBy("query_id").agg(found.alias("_found"))
    return with_reply(texts, F.col("_found")["chunk_text"], chars).where("abstract_reply is not null").select("query_id", "abstract_reply")

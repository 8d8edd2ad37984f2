import random

import pytest
from tokenizers import Regex, Tokenizer, models, pre_tokenizers

from tracelake.llm import tokencount
from tests.llm.conftest import AWKWARD

VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"


def library(vocabulary, byte_fallback=True):
    t = Tokenizer(models.Unigram(vocabulary, unk_id=0, byte_fallback=byte_fallback))
    t.pre_tokenizer = pre_tokenizers.Sequence([
        pre_tokenizers.Split(Regex("[ \\t\\n\\x0b\\x0c\\r]+"), "removed"),
        pre_tokenizers.Metaspace("▁", prepend_scheme="always", split=True)])
    return t


def texts(seed, n, alphabet):
    rng = random.Random(seed)
    return ["".join(rng.choice(alphabet) for _ in range(rng.randrange(30))) for _ in range(n)]


def test_counts_equal_the_library_on_a_public_vocabulary():
    vocabulary = tokencount.read_vocabulary(VOCABULARY)
    t, counter = library(vocabulary), tokencount.Counter(vocabulary)
    cases = texts(1, 1500, ["a", "b", "the", " ", "▁", "in", "<s>", "梦", "ǘ", "\n", "€", "🙂", "0", "<0x41>", ","])
    cases += [a[1] for a in AWKWARD if a[1]]
    assert counter.texts([c.encode() for c in cases])[0].tolist() == [len(t.encode(c).ids) for c in cases]


@pytest.mark.parametrize("seed", range(6))
def test_ties_and_unknowns_equal_the_library(seed):
    rng = random.Random(seed)
    pieces = {"<unk>", "▁"} | {"".join(rng.choice("abc▁") for _ in range(rng.randrange(1, 5))) for _ in range(12)}
    vocabulary = [("<unk>", 0.0)] + [(p, float(-rng.randrange(1, 4))) for p in sorted(pieces - {"<unk>"})]
    t, counter = library(vocabulary, False), tokencount.Counter(vocabulary, byte_fallback=False)
    cases = texts(seed, 400, "abcd ▁")
    assert counter.texts([c.encode() for c in cases])[0].tolist() == [len(t.encode(c).ids) for c in cases]


def test_awkward_documents(awkward, empty):
    vocabulary = tokencount.read_vocabulary(VOCABULARY)
    t = library(vocabulary)
    rows = tokencount.with_token_counts(awkward, vocabulary).select("text", "n_tokens").collect()
    assert len(rows) == len(AWKWARD)
    assert all(r["n_tokens"] == len(t.encode(r["text"] or "").ids) for r in rows)
    assert tokencount.with_token_counts(empty, vocabulary).count() == 0

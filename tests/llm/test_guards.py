"""Driver actions and broadcasts of the subpackage are reviewed here, with their bounds.

A new one fails this test until it is looked at and listed.
"""

import pathlib
import re

ROOT = pathlib.Path(__file__).resolve().parents[2] / "tabforge" / "llm"
ACTION = re.compile(r"\.(collect|toPandas|first|take|head|count|toLocalIterator)\(\)")
BROADCAST = re.compile(r"\.broadcast\(")

# file -> (number, what bounds the rows)
ACTIONS = {
    "components.py": (2, "one state row; a count"),
    "fingerprints.py": (5, "one row of cut points; two grouped counts (no actions); hot doc_ids, hot texts of them: groups / 4 each"),
    "hard_negatives.py": (5, "longest vector; SAMPLE rows; three counts"),
    "jaccard_join.py": (4, "arrays of fixed size; a count; two rows of totals"),
    "lm_scoring.py": (6, "a histogram by count level; the short list; the model; totals; HASHED rows; the model"),
    "mixing.py": (1, "one number"),
    "secrets.py": (1, "DICTIONARY words"),
    "shards.py": (3, "one row a virtual slot, twice; one number"),
    "warc.py": (3, "three counts"),
    "whitening.py": (5, "moments: dims^2 numbers; residues: dims + 1 a prime; k vectors; k^2 numbers; longest vector"),
}
BROADCASTS = {
    "bpe_codec.py": (1, "a vocabulary file"),
    "chat.py": (1, "a vocabulary file"),
    "jaccard_join.py": (4, "two sketches of fixed size; marks of fixed size; pairs counted small, twice"),
    "lm_scoring.py": (2, "the model and its short list, twice"),
    "shards.py": (2, "the slot map, two versions"),
    "token_counts.py": (1, "a vocabulary file"),
    "warc.py": (2, "at most 1 / HOT_SHARE groups; decisions counted small"),
}


def found(pattern):
    return {p.name: n for p in ROOT.glob("*.py") if (n := len(pattern.findall(p.read_text())))}


def test_driver_actions_are_reviewed():
    assert found(ACTION) == {k: n for k, (n, _) in ACTIONS.items()}


def test_broadcasts_are_reviewed():
    assert found(BROADCAST) == {k: n for k, (n, _) in BROADCASTS.items()}

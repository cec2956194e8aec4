import json

import pytest

from quarry.config import AXES, PRESETS, ConfigError, dangers, effective, expand_preset, load
from quarry.train import TrainerError, request, train

BASE = {"corpus": {"path": "data"}, "output": {"work_dir": "runs/demo", "model_prefix": "ocr_tokenizer"}}


def test_default_preset():
    c = effective(BASE)
    assert (c.preset, c.num_threads, c.sentencepiece.model_type, c.sentencepiece.byte_fallback) == ("ocr_multilingual", 16, "bpe", True)
    assert c.balancing.hierarchy == AXES and c.balancing.alpha == 0.7 and len(c.sentencepiece.user_defined_symbols) == 28


def test_presets_differ_as_documented():
    math, cjk = effective(BASE | {"preset": "ocr_math_heavy"}), effective(BASE | {"preset": "ocr_cjk_heavy"})
    assert (math.sentencepiece.vocab_size, math.sentencepiece.max_sentence_length) == (48_000, 32_768)
    assert "\\operatorname" in math.sentencepiece.user_defined_symbols and len(math.sentencepiece.user_defined_symbols) == 43
    assert (cjk.sentencepiece.vocab_size, cjk.sentencepiece.character_coverage, cjk.sentencepiece.max_sentencepiece_length) == (48_000, 0.99995, 4)


def test_user_overrides_win():
    c = effective(BASE | {"preset": "ocr_cjk_heavy", "num_threads": 8, "sentencepiece": {"vocab_size": 32_000}})
    assert (c.sentencepiece.vocab_size, c.num_threads, c.sentencepiece.max_sentencepiece_length) == (32_000, 8, 4)


def test_parents_come_first_and_lists_replace():
    presets = dict(PRESETS) | {"child": {"extends": "ocr_multilingual", "canonicalization": {"strip": ["bom"]}, "num_threads": 2}}
    c = effective(BASE | {"preset": "child"}, presets)
    assert (c.canonicalization.strip, c.num_threads, c.sentencepiece.vocab_size) == (["bom"], 2, 40_000)
    assert effective(BASE | {"preset": "child", "canonicalization": {"strip": []}}, presets).canonicalization.strip == []


@pytest.mark.parametrize(
    ("raw", "said"),
    [
        (BASE | {"num_threads": 0}, "num_threads"),
        (BASE | {"preset": "none"}, "`none` was not found"),
        (BASE | {"more": 1}, "more: unknown field"),
        (BASE | {"balancing": {"alphas": 1}}, "balancing.alphas: unknown field"),
        (BASE | {"balancing": {"alpha": "x"}}, "balancing.alpha"),
        (BASE | {"balancing": {"total_lines": True}}, "balancing.total_lines"),
        (BASE | {"sentencepiece": {"model_type": "unigram"}}, "model_type"),
        ({"output": BASE["output"]}, "corpus"),
    ],
)
def test_errors_name_the_field(raw, said):
    with pytest.raises(ConfigError, match=said):
        effective(raw)


def test_inheritance_cycles_and_gaps():
    with pytest.raises(ConfigError, match="among its own parents"):
        expand_preset("a", {"a": {"extends": "b"}, "b": {"extends": "a"}})
    with pytest.raises(ConfigError, match="balancing.enabled"):
        effective(BASE | {"preset": "p"}, {"p": {k: ({} if k == "balancing" else v) for k, v in PRESETS["ocr_multilingual"].items()}})


def test_files_and_catalogs(tmp_path):
    (tmp_path / "c.json").write_text(json.dumps(BASE))
    (tmp_path / "p.json").write_text(json.dumps({"version": 1, "default": "own", "presets": {"own": PRESETS["ocr_cjk_heavy"]}}))
    assert load(tmp_path / "c.json").preset == "ocr_multilingual"
    assert load(tmp_path / "c.json", tmp_path / "p.json").preset == "own"
    (tmp_path / "bad.json").write_text("{")
    with pytest.raises(ConfigError, match="failed to parse"):
        load(tmp_path / "bad.json")
    with pytest.raises(ConfigError, match="failed to read"):
        load(tmp_path / "none.json")


def test_dangers():
    assert dangers(effective(BASE)) == []
    assert len(dangers(effective(BASE | {"sentencepiece": {"add_dummy_prefix": True}, "canonicalization": {"strip": []}}))) == 2


def test_request_shape():
    r = request(effective(BASE), ["a.txt", "b.txt"])
    assert r["output"]["model"] == "runs/demo/ocr_tokenizer.model" and r["sentencepiece"]["input"] == ["a.txt", "b.txt"]
    assert (r["sentencepiece"]["model_type"], r["sentencepiece"]["normalization_rule_name"], r["sentencepiece"]["num_threads"]) == ("bpe", "identity", 16)
    dotted = effective(BASE | {"output": {"work_dir": "w", "model_prefix": "tok.v1"}})
    assert request(dotted, [])["output"]["model"] == "w/tok.model"


def test_training_needs_files(tmp_path):
    c = effective(BASE | {"output": {"work_dir": str(tmp_path), "model_prefix": "m"}})
    with pytest.raises(TrainerError, match="no training files"):
        train(c, [])
    with pytest.raises(TrainerError, match="training corpus file is missing"):
        train(c, [str(tmp_path / "none")])

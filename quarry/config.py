"""Configuration: presets, overlays and checks."""

from __future__ import annotations

import copy
import json
from dataclasses import asdict, dataclass, fields, is_dataclass
from pathlib import Path
from typing import Any, get_type_hints


class ConfigError(ValueError):
    """A configuration that can't be used."""


@dataclass
class Canonicalization:
    unicode_form: str
    strip: list[str]
    map_nbsp_to_space: bool
    fold_arabic_presentation_forms: bool
    soft_hyphen: str
    preserve_zwj_zwnj: bool
    preserve_compatibility_chars: bool


@dataclass
class Balancing:
    enabled: bool
    mode: str
    total_lines: int
    alpha: float
    hierarchy: list[str]
    min_keep_fraction: float
    max_downsample_ratio: float
    collapse_buckets_below_lines: int
    max_part_lines: int
    shuffle_seed: int


@dataclass
class Python:
    runner: str
    args: list[str]
    module: str


@dataclass
class SentencePiece:
    trainer: str
    python: Python
    model_type: str
    vocab_size: int
    character_coverage: float
    byte_fallback: bool
    normalization_rule_name: str
    add_dummy_prefix: bool
    remove_extra_whitespaces: bool
    split_by_unicode_script: bool
    split_by_whitespace: bool
    split_digits: bool
    max_sentencepiece_length: int
    max_sentence_length: int
    input_sentence_size: int
    shuffle_input_sentence: bool
    train_extremely_large_corpus: bool
    user_defined_symbols: list[str]


@dataclass
class Validation:
    mode: str
    line_policy: str
    issue_log: str
    include_line_text_in_log: bool
    round_trip_sample_per_bucket: int


@dataclass
class Corpus:
    path: str


@dataclass
class Output:
    work_dir: str
    model_prefix: str


@dataclass
class Config:
    """Everything a run needs, after presets are expanded."""

    preset: str
    num_threads: int
    corpus: Corpus
    output: Output
    canonicalization: Canonicalization
    balancing: Balancing
    sentencepiece: SentencePiece
    validation: Validation

    def to_dict(self) -> dict:
        return asdict(self)


SECTIONS = {"canonicalization": Canonicalization, "balancing": Balancing, "sentencepiece": SentencePiece, "validation": Validation}
CHOICES = {
    ("canonicalization", "unicode_form"): {"nfc"},
    ("canonicalization", "soft_hyphen"): {"line_final_to_hyphen_midline_strip"},
    ("balancing", "mode"): {"conservative"},
    ("sentencepiece", "trainer"): {"python_sentencepiece"},
    ("sentencepiece", "model_type"): {"bpe"},
    ("sentencepiece", "normalization_rule_name"): {"identity"},
    ("validation", "mode"): {"report"},
    ("validation", "line_policy"): {"fix_or_skip"},
}
STRIPS = {"bom", "zero_width_space"}
AXES = ["domain", "script", "language_hint", "source_group", "length_bin"]

_COMMANDS = "alpha approx begin beta cdot end frac gamma geq int left leq lim mathbf mathrm neq pi prod right sigma sqrt sum theta times"
_MORE_COMMANDS = "delta displaystyle epsilon infty lambda mu nabla omega operatorname overline partial phi rho underbrace underline"
_SIGNS = ["}", "{", "_", "^"]


def _commands(*lists: str) -> list[str]:
    return ["\\" + c for c in sorted(" ".join(lists).split())] + _SIGNS


def _preset(vocab: int, coverage: float, piece: int, sentence: int, symbols: list[str]) -> dict:
    return {
        "num_threads": 16,
        "canonicalization": dict(unicode_form="nfc", soft_hyphen="line_final_to_hyphen_midline_strip", strip=sorted(STRIPS), map_nbsp_to_space=True, fold_arabic_presentation_forms=True, preserve_compatibility_chars=True, preserve_zwj_zwnj=True),
        "balancing": dict(enabled=True, shuffle_seed=1337, alpha=0.7, total_lines=20_000_000, max_part_lines=1_000_000, mode="conservative", min_keep_fraction=0.5, max_downsample_ratio=4.0, collapse_buckets_below_lines=1000, hierarchy=list(AXES)),
        "sentencepiece": dict(
            trainer="python_sentencepiece", python=dict(runner="python", args=[], module="quarry.train"), model_type="bpe", normalization_rule_name="identity",
            vocab_size=vocab, character_coverage=coverage, max_sentencepiece_length=piece, max_sentence_length=sentence, user_defined_symbols=symbols,
            byte_fallback=True, add_dummy_prefix=False, remove_extra_whitespaces=False, split_digits=True, split_by_whitespace=True, split_by_unicode_script=True,
            shuffle_input_sentence=True, input_sentence_size=20_000_000, train_extremely_large_corpus=True,
        ),
        "validation": dict(line_policy="fix_or_skip", mode="report", round_trip_sample_per_bucket=1000, include_line_text_in_log=False, issue_log="reports/corpus_issues.jsonl"),
    }


DEFAULT_PRESET = "ocr_multilingual"
PRESETS: dict[str, dict] = {
    DEFAULT_PRESET: _preset(40_000, 0.9998, 8, 16_384, _commands(_COMMANDS)),
    "ocr_cjk_heavy": _preset(48_000, 0.99995, 4, 16_384, _commands(_COMMANDS)),
    "ocr_math_heavy": _preset(48_000, 0.9998, 8, 32_768, _commands(_COMMANDS, _MORE_COMMANDS)),
}


def read_json(path: str | Path) -> Any:
    try:
        text = Path(path).read_text(encoding="utf-8")
    except OSError as error:
        raise ConfigError(f"failed to read {path}: {error}") from error
    try:
        return json.loads(text)
    except ValueError as error:
        raise ConfigError(f"failed to parse {path}: {error}") from error


def _checked(value: Any, kind: Any, at: str) -> Any:
    """``value`` if it has the wanted type; the path of the field is part of the error."""
    if is_dataclass(kind):
        if not isinstance(value, dict):
            raise ConfigError(f"{at}: an object is wanted")
        return value
    wanted = {int: int, float: (int, float), bool: bool, str: str, list[str]: list}[kind]
    if not isinstance(value, wanted) or isinstance(value, bool) != (kind is bool):
        raise ConfigError(f"{at}: {getattr(kind, '__name__', 'list')} is wanted, not {json.dumps(value)}")
    if kind is int and value < 0:
        raise ConfigError(f"{at}: must not be negative")
    if kind == list[str] and not all(isinstance(x, str) for x in value):
        raise ConfigError(f"{at}: strings are wanted")
    return value


def _section(kind: type, given: dict, at: str, whole: bool) -> dict:
    hints = get_type_hints(kind)
    for name in given:
        if name not in hints:
            raise ConfigError(f"{at}.{name}: unknown field")
    out = {}
    for name, hint in hints.items():
        if given.get(name) is None:
            if whole:
                raise ConfigError(f"`{at}.{name}` is set by neither the preset nor its parents")
            continue
        value = _checked(given[name], hint, f"{at}.{name}")
        out[name] = _section(hint, value, f"{at}.{name}", whole) if is_dataclass(hint) else value
    return out


def _overlay(base: dict, top: dict) -> dict:
    """Fields of ``top`` win; objects merge, lists replace."""
    out = copy.deepcopy(base)
    for name, value in top.items():
        if value is not None:
            out[name] = _overlay(out.get(name) or {}, value) if isinstance(value, dict) else copy.deepcopy(value)
    return out


def expand_preset(name: str, presets: dict[str, dict], seen: tuple[str, ...] = ()) -> dict:
    if name in seen:
        raise ConfigError(f"preset `{name}` is among its own parents")
    if name not in presets:
        raise ConfigError(f"preset `{name}` was not found")
    own = {k: v for k, v in presets[name].items() if k not in ("extends", "description")}
    parent = presets[name].get("extends")
    return _overlay(expand_preset(parent, presets, (*seen, name)), own) if parent else own


def _build(kind: type, given: dict) -> Any:
    return kind(**{f.name: _build(h, given[f.name]) if is_dataclass(h := get_type_hints(kind)[f.name]) else given[f.name] for f in fields(kind)})


def effective(raw: dict, presets: dict[str, dict] | None = None, default: str = DEFAULT_PRESET) -> Config:
    """The configuration of ``raw`` over its preset: parents first, then the preset, then ``raw``."""
    allowed = {"preset", "num_threads", "corpus", "output", *SECTIONS}
    for name in raw:
        if name not in allowed:
            raise ConfigError(f"{name}: unknown field")
    for name, kind in (("corpus", Corpus), ("output", Output)):
        if not isinstance(raw.get(name), dict):
            raise ConfigError(f"{name}: missing field")
    for name, kind in SECTIONS.items():
        _section(kind, raw.get(name) or {}, name, False)
    name = raw.get("preset") or default
    merged = _overlay(expand_preset(name, presets or PRESETS), {k: v for k, v in raw.items() if k != "preset"})
    threads = merged.get("num_threads")
    if threads is None:
        raise ConfigError("`num_threads` is set by neither the preset nor its parents")
    if not isinstance(threads, int) or threads <= 0:
        raise ConfigError("invalid preset field `num_threads`: must be greater than zero")
    sections = {n: _build(k, _section(k, merged.get(n) or {}, n, True)) for n, k in SECTIONS.items()}
    for (section, attribute), choices in CHOICES.items():
        if (value := getattr(sections[section], attribute)) not in choices:
            raise ConfigError(f"{section}.{attribute}: unknown value `{value}`")
    if unknown := set(sections["canonicalization"].strip) - STRIPS:
        raise ConfigError(f"canonicalization.strip: unknown value `{sorted(unknown)[0]}`")
    ends = [_build(k, _section(k, merged[n], n, True)) for n, k in (("corpus", Corpus), ("output", Output))]
    return Config(name, threads, *ends, **sections)


def load(path: str | Path, preset_catalog: str | Path | None = None) -> Config:
    """The configuration in a JSON file; presets from a catalog file of ``version, default, presets``, or those built in."""
    if preset_catalog is None:
        return effective(read_json(path))
    catalog = read_json(preset_catalog)
    return effective(read_json(path), catalog["presets"], catalog.get("default", DEFAULT_PRESET))


def dangers(config: Config) -> list[str]:
    """What a trainer would do to text that was repaired without loss; an extension, empty for the presets."""
    s = config.sentencepiece
    found = []
    if not s.byte_fallback and s.character_coverage >= 1:
        found.append("character_coverage 1.0 without byte_fallback fills the vocabulary with rare characters")
    if s.remove_extra_whitespaces or s.add_dummy_prefix:
        found.append("white space doesn't survive a round trip")
    if not config.canonicalization.strip:
        found.append("byte order marks and zero width spaces reach the vocabulary")
    return found



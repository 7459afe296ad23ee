"""Deterministic backends: stand-ins for a model server in tests, oracle queries and the benchmark.

Their rules are simple enough to restate in SQL. No job falls back to them: a job
without a backend is an error.
"""

from __future__ import annotations

import json
import re
from dataclasses import dataclass, field

import numpy as np
import pandas as pd

from ..config import ModelParams

# Keyword rules of the stand-in classifier, checked in order on
# the lower-cased prompt; first hit gives the raw label the "model" answers.
DEFAULT_KEYWORD_RULES: tuple[tuple[str, str], ...] = (
    ("bolt", "materialeindkøb"),
    ("rod", "Materiale"),
    ("plate", "materialeindkøb"),
    ("gear", "tjenesteydelse"),
    ("widget", "Tjeneste (service)"),
    ("ring", "automatisk tjeneste"),
    ("anvil", "andet"),
)
DEFAULT_NO_RULE_LABEL = "ved ikke"


@dataclass(frozen=True)
class KeywordBackend:
    """Rules on the prompt -> JSON (``mode='json'``) or prose with thinking.

    JSON answer: ``{"label": <rule label>, "reason": "rule <needle>", "secure":
    <prompt length % score_mod>, ...}``; with ``fields`` naming which keys to
    write. Prose answer: ``<think>`` + the prompt + ``</think>`` then
    ``Svaret er **<label>**.``
    """

    mode: str = "json"
    rules: tuple[tuple[str, str], ...] = DEFAULT_KEYWORD_RULES
    default_label: str = DEFAULT_NO_RULE_LABEL
    fields: tuple[str, ...] = ("label", "reason", "secure")
    score_mod: int = 12
    # Seconds reported for each token; None leaves it to the clock.
    seconds_per_token: float | None = None
    # M6: per-job model settings; max_tokens cuts the answer after that many
    # space-separated tokens and reports the length stop, as a server would.
    params: ModelParams | None = None

    def build(self) -> KeywordBackend:
        return self

    def respond(self, requests: pd.DataFrame) -> pd.DataFrame:
        texts, n_tokens, stops = [], [], []
        most = self.params.max_tokens if self.params is not None else 0
        for prompt in requests["prompt"]:
            prompt = str(prompt)
            low = prompt.lower()
            needle, label = next((rule for rule in self.rules if rule[0] in low), ("none", self.default_label))  # first matching rule wins
            if self.mode == "prose":
                text = f"<think>\n{prompt}\n</think>\nSvaret er **{label}**."
            else:
                values = {
                    "label": f'"{label}"',
                    "reason": f'"rule {needle}"',
                    "reason_for": f'"rule {needle}"',
                    "reason_against": f'"no rule before {needle}"',
                    "secure": str(len(prompt) % self.score_mod),
                }
                text = "{" + ", ".join(f'"{f}": {values[f]}' for f in self.fields) + "}"
            n = text.count(" ") + 1
            if most and n > most:
                text, n = " ".join(text.split(" ")[:most]), most
                stops.append("maxPredictedTokensReached")
            else:
                stops.append("eosFound")
            texts.append(text)
            n_tokens.append(n)
        out = pd.DataFrame({"response": texts, "n_tokens": n_tokens, "stop_reason": stops})
        if self.seconds_per_token is not None:
            out["seconds"] = out["n_tokens"] * self.seconds_per_token
        return out


_KEY = re.compile(r"#(\d+)")


@dataclass(frozen=True)
class FaultyBackend:
    """Wraps another backend and breaks answers by the ``#<key>`` in the prompt.

    Rules in order on key k: ``k % raise_every == 0`` fails: the answer is an
    ``error`` for that request or, with ``raises``, the whole call raises;
    ``k % none_every == 0`` returns null;
    ``k % bad_every == 0`` returns non-JSON text; ``k % empty_every == 0`` returns
    ``''``; ``k % cut_every == 0`` returns the first half of the inner answer.
    """

    inner: KeywordBackend = field(default_factory=KeywordBackend)
    raise_every: int = 13
    none_every: int = 17
    bad_every: int = 7
    empty_every: int = 11
    cut_every: int = 5
    raises: bool = False

    def build(self) -> FaultyBackend:
        return self

    def respond(self, requests: pd.DataFrame) -> pd.DataFrame:
        keys = requests["prompt"].astype(str).str.extract(_KEY, expand=False).astype("float64")
        fails = keys % self.raise_every == 0
        if self.raises and fails.any():
            raise RuntimeError(f"backend failure for key multiple of {self.raise_every}")
        out = self.inner.respond(requests)
        resp = out["response"].astype(object).copy()
        none = (keys % self.none_every == 0) & ~fails
        bad = (keys % self.bad_every == 0) & ~none & ~fails
        empty = (keys % self.empty_every == 0) & ~none & ~bad & ~fails
        cut = (keys % self.cut_every == 0) & ~none & ~bad & ~empty & ~fails
        resp[cut] = [s[: len(s) // 2] for s in resp[cut]]
        resp[empty] = ""
        resp[bad] = "Jeg er ikke sikker."
        resp[none] = None
        out["response"] = resp
        out.loc[none.to_numpy(), "stop_reason"] = "failed"
        out["error"] = pd.Series([None] * len(out), index=out.index, dtype=object)
        for c, value in (("response", None), ("n_tokens", np.nan), ("stop_reason", None), ("error", "backend failure")):
            out[c] = out[c].astype(object)
            out.loc[fails.to_numpy(), c] = value
        return out


@dataclass(frozen=True)
class PageReaderBackend:
    """Stand-in vision model (M3): reads a list of page contents per request.

    A page is decoded as UTF-8 text; the answer has one line per page,
    ``side <n>: <words> ord, <chars> tegn``. A request without readable pages gets
    a null answer, like the reference when no image could be prepared.
    """

    pages_col: str = "pages"

    def build(self) -> PageReaderBackend:
        return self

    def respond(self, requests: pd.DataFrame) -> pd.DataFrame:
        out = []
        for pages in requests[self.pages_col]:
            lines = []
            if pages is not None:
                for i, raw in enumerate(pages, start=1):
                    if raw is None:
                        continue  # a bad page is skipped
                    txt = bytes(raw).decode("utf-8", errors="replace")
                    lines.append(f"side {i}: {len(txt.split())} ord, {len(txt)} tegn")
            out.append("\n".join(lines) if lines else None)
        return pd.DataFrame({"response": out, "stop_reason": "eosFound"})


_PAGE_LINE = re.compile(r"side (\d+): (\d+) ord, (\d+) tegn")


@dataclass(frozen=True)
class InvoiceWriterBackend:
    """Stand-in text model for the second reader stage (M4).

    Reads the page lines of the first answer out of the prompt and answers an
    invoice as JSON: creditor from the ``Kreditor: <x>`` line of the prompt, one
    invoice line per page (description ``side <n>``, quantity = words, amount =
    characters), ``secure`` = number of pages capped at 10.
    """

    def build(self) -> InvoiceWriterBackend:
        return self

    def respond(self, requests: pd.DataFrame) -> pd.DataFrame:
        out = []
        for prompt in requests["prompt"]:
            cred = re.search(r"Kreditor: (\S+)", prompt)
            lines = [
                {"fakturalinje_beskrivelse": f"side {m[0]}", "antal": int(m[1]), "linje_beløb": float(m[2])}
                for m in _PAGE_LINE.findall(prompt)
            ]
            doc = {"kreditor": cred.group(1) if cred else None, "fakturalinjer": lines, "secure": min(len(lines), 10)}
            out.append(json.dumps(doc, ensure_ascii=False))
        return pd.DataFrame({"response": out, "stop_reason": "eosFound"})


@dataclass(frozen=True)
class EchoBackend:
    """Answers the prompt itself (zero-latency path benchmark)."""

    def build(self) -> EchoBackend:
        return self

    def respond(self, requests: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"response": requests["prompt"], "stop_reason": "eosFound"})

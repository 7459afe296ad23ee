"""Test-only model backends (importable by Python workers)."""

from dataclasses import dataclass

import pandas as pd


@dataclass(frozen=True)
class RaiseOn:
    """Raises for the whole batch whenever a prompt contains ``bad``."""

    def build(self):
        return self

    def respond(self, requests: pd.DataFrame) -> pd.DataFrame:
        if requests["prompt"].str.contains("bad").any():
            raise RuntimeError("boom")
        return pd.DataFrame({"response": "ok:" + requests["prompt"], "n_tokens": 1})


@dataclass(frozen=True)
class WrongLength:
    def build(self):
        return self

    def respond(self, requests):
        return pd.DataFrame({"response": ["x"] * (len(requests) + 1)})


@dataclass(frozen=True)
class NullAnswers:
    def build(self):
        return self

    def respond(self, requests):
        return pd.DataFrame({"response": [None] * len(requests)})


@dataclass(frozen=True)
class Counting:
    """Echo backend that counts every request it receives (Spark accumulator)."""

    acc: object = None

    def build(self):
        return self

    def respond(self, requests: pd.DataFrame) -> pd.DataFrame:
        self.acc.add(len(requests))
        return pd.DataFrame({"response": requests["prompt"]})


@dataclass(frozen=True)
class MaxBatch:
    """Refuses batches larger than ``limit`` requests."""

    limit: int = 7

    def build(self):
        return self

    def respond(self, requests: pd.DataFrame) -> pd.DataFrame:
        if len(requests) > self.limit:
            raise RuntimeError("batch too large")
        return pd.DataFrame({"response": requests["prompt"]})


@dataclass(frozen=True)
class EchoPair:
    """Answers the prompt and the request column ``extra``."""

    def build(self):
        return self

    def respond(self, requests: pd.DataFrame) -> pd.DataFrame:
        extra = requests["extra"].where(requests["extra"].notna(), "null")
        return pd.DataFrame({"response": requests["prompt"] + "/" + extra})


@dataclass(frozen=True)
class CountingFaulty:
    """Counts requests (Spark accumulator); raises for a slice with a key divisible by ``every``."""

    acc: object
    every: int

    def build(self):
        return self

    def respond(self, requests: pd.DataFrame) -> pd.DataFrame:
        self.acc.add(len(requests))
        if (requests["prompt"].str[1:].astype(int) % self.every == 0).any():
            raise RuntimeError("boom")
        return pd.DataFrame({"response": requests["prompt"]})


@dataclass(frozen=True)
class PromptLengths:
    """Answers the length of the prompt, and counts the requests."""

    acc: object

    def build(self):
        return self

    def respond(self, requests: pd.DataFrame) -> pd.DataFrame:
        self.acc.add(len(requests))
        return pd.DataFrame({"response": requests["prompt"].str.len().astype(str)})


@dataclass(frozen=True)
class BrokenWriter:
    """A second reader stage that fails, cuts its answer or answers something else, by creditor."""

    def build(self):
        return self

    def respond(self, requests: pd.DataFrame) -> pd.DataFrame:
        good = '{"kreditor": "k", "fakturalinjer": [{"fakturalinje_beskrivelse": "a", "antal": 2.0, "linje_beløb": 3.5}], "secure": 7}'
        out = []
        for p in requests["prompt"]:
            if "Kreditor: raise" in p:
                raise RuntimeError("writer down")
            kind = p.split("Kreditor: ")[1].split("\n")[0]
            out.append({"cut": good[:40], "empty": "", "none": None, "nolines": '{"kreditor": "k", "fakturalinjer": [], "secure": 1}'}.get(kind, good))
        return pd.DataFrame({"response": out})


@dataclass(frozen=True)
class WorkerMemory:
    """Answers with the length of the prompt, the prompts of its call and the worker's peak memory in MB."""

    def build(self):
        return self

    def respond(self, requests: pd.DataFrame) -> pd.DataFrame:
        import resource

        peak = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss // 1024
        return pd.DataFrame({"response": [f"{len(p)} {len(requests)} {peak}" for p in requests["prompt"]]})

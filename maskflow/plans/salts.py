"""Salts: secret text per salt key, held on the driver and never logged."""

from __future__ import annotations

import json
import os
import secrets
import tempfile
import threading
from collections.abc import Iterable, Mapping
from pathlib import Path


class Salts:
    """Mapping from salt key to salt, optionally backed by a JSON file.

    Without ``create`` an unknown key is an error: a salt made up on the spot
    would give pseudonyms that no other table or later run can reproduce.
    Threads may share one object: a key gets one salt, and files are replaced whole.
    """

    def __init__(
        self,
        mapping: Mapping[str, str] | None = None,
        *,
        path: str | os.PathLike | None = None,
        create: bool = False,
    ):
        self._salts = dict(mapping or {})
        self._path = Path(path) if path is not None else None
        self._create = create
        self._lock = threading.RLock()

    @classmethod
    def load(cls, path: str | os.PathLike, create: bool = False) -> Salts:
        """Salts of a JSON file; a missing file counts as empty when ``create`` is set."""
        file = Path(path)
        if not file.exists():
            if not create:
                raise FileNotFoundError(f"no salt file at {path}")
            return cls(path=file, create=True)
        return cls(json.loads(file.read_text() or "{}"), path=file, create=create)

    @classmethod
    def generate(cls, keys: Iterable[str]) -> Salts:
        return cls({key: secrets.token_hex(128) for key in keys})

    def get(self, key: str) -> str:
        return self.resolve([key])[key]

    def resolve(self, keys: Iterable[str]) -> dict[str, str]:
        """Salts of all keys, new ones made and saved at once."""
        with self._lock:
            keys = list(keys)
            new = [key for key in dict.fromkeys(keys) if key not in self._salts]
            if new and not self._create:
                raise KeyError(f"no salt under key {new[0]!r}")
            if new:
                self._salts |= {key: secrets.token_hex(128) for key in new}
                if self._path is not None:
                    self.save(self._path)
            return {key: self._salts[key] for key in keys}

    @property
    def creates(self) -> bool:
        return self._create

    def save(self, path: str | os.PathLike) -> None:
        """Write the file in one step, readable by its owner only."""
        target = Path(path)
        with self._lock:
            # mkstemp makes a file of a new name that only its owner may read.
            handle, part = tempfile.mkstemp(prefix=f".{target.name}-", dir=target.parent)
            with open(handle, "w") as out:
                json.dump(self._salts, out)
            os.replace(part, target)

    def __contains__(self, key: str) -> bool:
        return key in self._salts

    def __repr__(self) -> str:
        return f"Salts(<{len(self._salts)} keys>)"

"""Shared Column builders."""

from .pytext import (PY_WS, PY_WORD, py_strip, py_split, py_isdigit, literal_split,
                     md5_key, py_str)

__all__ = ["PY_WS", "PY_WORD", "py_strip", "py_split", "py_isdigit", "literal_split",
           "md5_key", "py_str"]

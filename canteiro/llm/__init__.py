"""Operations for preparing training data: nothing else in the library imports this subpackage."""

from canteiro.llm.queries import QUERIES

__all__ = ["QUERIES"]

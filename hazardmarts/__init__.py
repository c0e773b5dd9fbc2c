"""Environmental-exposure marts as Spark DataFrame functions.

Every operator takes DataFrames and column names and returns a lazy DataFrame, so the same
code runs on landed weather snapshots and on any other table of the right shape.
"""

from hazardmarts.params import Lattice, Params

__all__ = ["Lattice", "Params"]

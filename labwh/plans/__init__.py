"""Reports of the warehouse: each takes detail tables and an ``as_of`` date and returns one
DataFrame. Reading the inputs and writing the result are left to ``labwh.sources``."""

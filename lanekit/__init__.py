"""lanekit: warehouse export/restore, SQL view steps and route-level load-rate
mart operators, written on the PySpark DataFrame / SQL / catalog APIs."""

__version__ = "0.1.0"

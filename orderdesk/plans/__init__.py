"""Registered checks: each pairs a Spark job over the fixture views with an
independent DuckDB SQL oracle (``registry``), and the comparison tool
(``compare``)."""

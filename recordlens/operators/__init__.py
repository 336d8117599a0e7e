"""DataFrame operators with column names as arguments.

All are lazy, except that entity resolution and group positions write what several branches
read to the reliable checkpoint folder (see ``session.materialise``).
"""

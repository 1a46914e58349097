"""ticketloom: support-ticket corpus analytics and retrieval as PySpark DataFrame operators.

Executors import this package: call :func:`ticketloom.deploy.ship_package` once for a session
whose workers do not have it on their path.
"""

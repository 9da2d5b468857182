"""The whole flows, from landed tables to finished tables."""

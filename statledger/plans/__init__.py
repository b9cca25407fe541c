"""Reports, collectors, alerts and worklists composed from the operators."""

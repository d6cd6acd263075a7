"""The booking mart (steps, metric catalogue, runner) and the registered queries."""

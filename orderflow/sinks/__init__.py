"""Result tables that stay right when a batch is delivered twice."""

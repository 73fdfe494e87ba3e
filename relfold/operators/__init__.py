"""DataFrame operators: joins, roll-ups, ordered windows, intervals, encodings, evaluation."""

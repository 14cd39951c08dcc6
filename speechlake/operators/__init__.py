"""DataFrame to DataFrame operators; none creates a session or triggers a job unless it says so."""

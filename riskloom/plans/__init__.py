"""Stage views, marts, findings and checks over the five-table model."""
